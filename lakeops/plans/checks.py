"""Data-quality checks: each returns the failing rows, so empty means passed."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.functions.text import base_plan_type
from lakeops.operators.aggregates import duplicates, share_of_total
from lakeops.operators.joins import anti_keys
from lakeops.operators.nested import flatten_array


def not_numeric(df: DataFrame, column: str) -> DataFrame:
    """Values that are not numbers; NULL is one of them."""
    return df.select(F.col(column).alias("numeric_field")).filter(F.col("numeric_field").try_cast("decimal(38,9)").isNull())


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[str], name: str = "base_plan_type") -> DataFrame:
    """Base values (before the first '_') outside a list; NULL is not checked."""
    return df.select(base_plan_type(F.col(column)).alias(name)).filter(~F.col(name).isin(list(accepted)))


def nested_duplicates(df: DataFrame, keys: Sequence[str], array: str, fields: Mapping[str, Column]) -> DataFrame:
    """Elements that occur more than once in the arrays of a key."""
    return duplicates(flatten_array(df, array, fields, keys), [*keys, *fields])


def orphan_keys(df: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    return anti_keys(df, parent, key, parent_key)


def missing_dates(df: DataFrame, column: str, today: Column, oldest: int = 31, newest: int = 2, name: str = "missing_snapshot_date") -> DataFrame:
    """Days of a window before today without any row."""
    first, last = F.date_sub(today, oldest), F.date_sub(today, newest)
    days = df.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias(name))
    day = F.col(column).cast("date")
    present = df.filter((day >= first) & (day <= last)).select(day.alias(name)).distinct()
    return days.join(present, name, "left_anti")


def count_drops(
    df: DataFrame, column: str, today: Column, ratio: float = 0.85, oldest: int = 31, newest: int = 2
) -> DataFrame:
    """Days with fewer than ``ratio`` of the rows of the day before.

    The window runs over one row per day, at most as many as the checked days.
    """
    day = F.col(column).cast("date")
    recent = df.filter((day >= F.date_sub(today, oldest)) & (day <= F.date_sub(today, newest)))
    daily = recent.groupBy(day.alias("snapshot_date")).agg(F.count(F.lit(1)).alias("row_count"))
    prior = F.lag("row_count").over(Window.partitionBy(F.lit(1)).orderBy("snapshot_date"))
    drop = (F.col("prior_row_count") - F.col("row_count")) / F.col("prior_row_count") * 100
    return (
        daily.withColumn("prior_row_count", prior)
        .filter(F.col("row_count") < F.col("prior_row_count") * ratio)
        .withColumn("pct_drop", F.round(drop, 1))
    )


def conflicting_mapping(facts: DataFrame, mapping: DataFrame, on: str, actual: str, expected: str) -> DataFrame:
    """Facts whose explicit mapping names another value, compared as text."""
    explicit = mapping.filter(F.col(expected).isNotNull()).select(on, expected)
    return facts.join(explicit, on).filter(F.col(expected).cast("string") != F.col(actual).cast("string")).select(actual, on, expected)


def uncovered_fallback(
    contracts: DataFrame, accounts: DataFrame, allocations: DataFrame, resolved: DataFrame, own_signal: str
) -> DataFrame:
    """Contracts that only the account's fallback could resolve, and did not.

    contracts: contract_id, account_id and the contract's own signal; accounts: account_id with a
    fallback; allocations and resolved: contract_id.
    """
    needing = (
        contracts.filter(F.col("contract_id").isNotNull() & F.col(own_signal).isNull())
        .join(accounts.select("account_id").distinct(), "account_id", "left_semi")
        .join(allocations.select("contract_id").distinct(), "contract_id", "left_anti")
    )
    return needing.select("contract_id", "account_id").distinct().join(
        resolved.select("contract_id").distinct(), "contract_id", "left_anti"
    )


def excessive_share(
    df: DataFrame, column: str, value: str, max_rows: int = 100, max_percent: float = 5.0
) -> DataFrame:
    """The watched value when it has too many rows or too large a share of them."""
    reason = F.when(
        F.col("record_count") > max_rows, f"High volume threshold exceeded (>{max_rows} records)"
    ).when(F.col("percentage_of_total") > max_percent, f"High percentage threshold exceeded (>{max_percent:g}% of total)")
    watched = share_of_total(df, column).filter(F.col(column) == value).withColumn("failure_reason", reason)
    return watched.filter(F.col("failure_reason").isNotNull()).select(
        "record_count", F.round("percentage_of_total", 2).alias("percentage_of_total"), "failure_reason"
    )


def missing_value(df: DataFrame, dimension: DataFrame, on: str, column: str, where: Column) -> DataFrame:
    """Joined rows under a filter whose required column is NULL."""
    return df.join(dimension, on).filter(where & F.col(column).isNull())


def low_share_days(df: DataFrame, day: Column, flag: Column, counted: str, max_percent: float = 1.0) -> DataFrame:
    """Days on which at most ``max_percent`` of the rows have the flag."""
    daily = df.groupBy(day.alias("date_day")).agg(
        F.count(counted).alias("total"), F.coalesce(F.sum(flag.cast("int")), F.lit(0)).alias("flagged")
    )
    percent = F.round(F.col("flagged") * 100.0 / F.col("total"), 2)
    return daily.withColumn("percent_flagged", percent).filter(F.col("percent_flagged") <= max_percent)


def not_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return duplicates(df, keys, "duplicate_count")


def empty_table(df: DataFrame) -> DataFrame:
    """One row when the table has none."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") == 0)


def count_mismatch(read: DataFrame, written: DataFrame) -> DataFrame:
    """One row when two tables differ in size."""
    sides = read.select(F.lit(1).alias("r"), F.lit(0).alias("w")).unionByName(
        written.select(F.lit(0).alias("r"), F.lit(1).alias("w"))
    )
    both = sides.agg(F.coalesce(F.sum("r"), F.lit(0)).alias("rows_read"), F.coalesce(F.sum("w"), F.lit(0)).alias("rows_written"))
    return both.filter(F.col("rows_read") != F.col("rows_written"))


def not_matching(df: DataFrame, column: str, pattern: str, deleted: Column | None = None) -> DataFrame:
    """Rows, other than deleted ones, whose value does not match a pattern."""
    rows = df if deleted is None else df.filter(~deleted)
    return rows.filter(~F.coalesce(F.col(column).rlike(pattern), F.lit(False)))


def stale(df: DataFrame, column: str, now: Column, max_age: str) -> DataFrame:
    """One row when the newest timestamp is older than an interval, or there is none."""
    newest = df.agg(F.max(column).alias("last_updated"))
    fresh = F.col("last_updated") >= now - F.expr(f"interval {max_age}")
    return newest.filter(~F.coalesce(fresh, F.lit(False)))


#: SQL types by the name that they have in a contract.
CONTRACT_TYPES = {"BIGINT": "integer", "DECIMAL": "decimal", "FLOAT": "decimal", "DOUBLE": "decimal", "STRING": "text", "BOOLEAN": "boolean", "ARRAY": "array", "OBJECT": "object"}


def found_fields(rows: DataFrame, record: str) -> DataFrame:
    """(column_name, actual, n_rows): which fields the JSON records of a table have, of which types, in how many records.

    Fields are found by name in every record, one pass that counts before it shuffles. A null field counts as missing, and so does any field of
    a record that is no object or malformed.
    """
    parsed = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.try_parse_json(F.col(record).outer()))).filter(F.col("key").isNotNull())
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    named = F.create_map(*[F.lit(x) for pair in CONTRACT_TYPES.items() for x in pair])
    typed = parsed.select(F.col("key").alias("column_name"), kind.alias("_kind")).filter(F.col("_kind") != "VOID")
    return typed.groupBy("column_name", F.coalesce(named[F.col("_kind")], F.lower("_kind")).alias("actual")).agg(F.count(F.lit(1)).alias("n_rows"))


def contract_violations(rows: DataFrame, record: str, contract: DataFrame) -> DataFrame:
    """(column_name, expected, actual, n_rows): how many JSON records break a contract of (column_name, expected), and by what.

    A record breaks it by a field of another type, by a field that the contract does not have (``expected`` is NULL), and by the lack of one it has
    (``actual`` is NULL). Types are those of ``CONTRACT_TYPES``. The records are read twice and only counts are shuffled.
    """
    found = found_fields(rows, record)
    wanted = contract.select("column_name", "expected")
    met = found.join(wanted, "column_name", "full_outer")
    wrong = met.filter(F.col("actual").isNotNull() & ~F.col("actual").eqNullSafe(F.col("expected"))).select("column_name", "expected", "actual", "n_rows")
    total = rows.agg(F.count(F.lit(1)).alias("_all"))
    held = met.filter(F.col("expected").isNotNull()).groupBy("column_name", "expected").agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("_held"))
    lacking = held.join(F.broadcast(total), F.col("_held") < F.col("_all"))  # one row
    return wrong.unionByName(lacking.select("column_name", "expected", F.lit(None).cast("string").alias("actual"), (F.col("_all") - F.col("_held")).alias("n_rows")))


def schema_violations(df: DataFrame, expected: StructType) -> DataFrame:
    """Columns that are missing, additional or of another type than the contract."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = [(n, want.get(n), have.get(n)) for n in [*want, *[n for n in have if n not in want]] if want.get(n) != have.get(n)]
    return df.sparkSession.createDataFrame(rows, "column_name string, expected string, actual string")


def catalog_metadata(spark: SparkSession, database: str) -> DataFrame:
    """Tables and columns of a catalog database with their comments."""
    rows = []
    for t in spark.catalog.listTables(database):
        for c in spark.catalog.listColumns(t.name, database):
            rows.append((database, t.name, t.tableType, t.description, c.name, c.description))
    return spark.createDataFrame(
        rows, "schema_name string, table_name string, table_type string, table_description string, column_name string, column_description string"
    )


def blank(column: Column) -> Column:
    return F.coalesce(F.trim(column), F.lit("")) == ""


def missing_descriptions(metadata: DataFrame, description: str, ignore: Column | None = None) -> DataFrame:
    """Catalog rows without a description, apart from ignored ones."""
    rows = metadata if ignore is None else metadata.filter(~F.coalesce(ignore, F.lit(False)))
    return rows.filter(blank(F.col(description)))


IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]*"


def is_safe_identifier(name: Column) -> Column:
    """Can a name stand in SQL text as it is? NULL cannot."""
    return F.coalesce(F.regexp_like(name, F.lit(f"\\A{IDENTIFIER}\\z")), F.lit(False))


def safe_identifier(name: str) -> str:
    """The name, if it can stand in SQL text as it is."""
    if not re.fullmatch(IDENTIFIER, name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


@dataclass(frozen=True)
class Check:
    name: str
    failing: DataFrame
    severity: str = "ERROR"


@dataclass(frozen=True)
class Rule:
    """A check that a single pass over its table decides.

    ``failing`` is true for a failing row; of a ``whole`` rule it is an aggregate that is true when the table fails. NULL does not fail.
    """

    name: str
    failing: Column
    severity: str = "ERROR"
    whole: bool = False


def numeric_rule(name: str, column: str, severity: str = "ERROR") -> Rule:
    return Rule(name, F.col(column).cast("string").try_cast("decimal(38,9)").isNull(), severity)


def accepted_rule(name: str, column: str, accepted: Sequence[str], severity: str = "ERROR") -> Rule:
    return Rule(name, ~base_plan_type(F.col(column)).isin(list(accepted)), severity)


def matching_rule(name: str, column: str, pattern: str, deleted: Column | None = None, severity: str = "ERROR") -> Rule:
    """As ``not_matching``: NULL fails, deleted rows do not."""
    failing = ~F.coalesce(F.col(column).rlike(pattern), F.lit(False))
    return Rule(name, failing if deleted is None else failing & ~F.coalesce(deleted, F.lit(False)), severity)


def required_rule(name: str, column: str, where: Column | None = None, severity: str = "ERROR") -> Rule:
    failing = F.col(column).isNull()
    return Rule(name, failing if where is None else failing & where, severity)


def filled_rule(name: str, severity: str = "WARN") -> Rule:
    """The table has a row."""
    return Rule(name, F.count(F.lit(1)) == 0, severity, True)


def fresh_rule(name: str, column: str, now: Column, max_age: str, severity: str = "ERROR") -> Rule:
    """As ``stale``: no row at all is stale."""
    return Rule(name, ~F.coalesce(F.max(column) >= now - F.expr(f"interval {max_age}"), F.lit(False)), severity, True)


def share_rule(name: str, flag: Column, max_rows: int = 100, max_percent: float = 5.0, severity: str = "ERROR") -> Rule:
    """At most so many rows, and such a share of all, have the flag."""
    flagged = F.count_if(flag)
    return Rule(name, (flagged > max_rows) | (flagged * 100.0 > F.count(F.lit(1)) * max_percent), severity, True)


def run_rules(df: DataFrame, rules: Sequence[Rule], key: str | None = None, samples: int = 3) -> DataFrame:
    """One row per rule: name, passed, severity, failing rows and, with a ``key``, up to ``samples`` keys of failing rows as text.

    All rules of a table are conditional aggregates of one scan. The sample is the smallest failing key of each of so many hash classes.
    """
    aggs, out = [], []
    for i, rule in enumerate(rules):
        failing = F.coalesce(rule.failing, F.lit(False))
        aggs.append((F.when(failing, 1).otherwise(0).cast("bigint") if rule.whole else F.count_if(failing)).alias(f"_n{i}"))
        kept = []
        if key is not None and not rule.whole:
            for j in range(samples):
                aggs.append(F.min(F.when(failing & (F.pmod(F.xxhash64(key), F.lit(samples)) == j), F.col(key))).cast("string").alias(f"_s{i}_{j}"))
                kept.append(F.col(f"_s{i}_{j}"))
        keys = F.array_sort(F.array_compact(F.array(*kept))) if kept else F.array().cast("array<string>")
        out.append(F.struct(
            F.lit(rule.name).alias("check_name"), (F.col(f"_n{i}") == 0).alias("passed"), F.lit(rule.severity).alias("severity"),
            F.col(f"_n{i}").alias("failing_rows"), keys.alias("sample_keys"),
        ))
    return df.agg(*aggs).select(F.inline(F.array(*out)))


def run_checks(checks: Sequence[Check], tables: Sequence[tuple[DataFrame, Sequence[Rule]]] = ()) -> DataFrame:
    """One row per check: name, passed, severity, failing rows. All run as one Spark job, the rules of a table as one pass over it."""
    parts = [
        c.failing.agg(F.count(F.lit(1)).alias("failing_rows")).select(
            F.lit(c.name).alias("check_name"), (F.col("failing_rows") == 0).alias("passed"),
            F.lit(c.severity).alias("severity"), "failing_rows",
        )
        for c in checks
    ]
    parts += [run_rules(df, rules).drop("sample_keys") for df, rules in tables]
    return reduce(DataFrame.unionByName, parts)
