"""Aggregations with a shape of their own: shares, breakdowns, pivots, flakiness, activity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.joins import merge_series
from lakeops.operators.ordered import first_per_key


def totals_and_breakdown(df: DataFrame, group: str, measures: Mapping[str, Column], all_label: str = "(all)") -> DataFrame:
    """One row per group and one for everything, from a single pass."""
    level = F.grouping(group)
    out = df.rollup(group).agg(*[c.alias(n) for n, c in measures.items()], level.alias("_level"))
    return out.withColumn(group, F.when(F.col("_level") == 1, all_label).otherwise(F.col(group))).drop("_level")


def duplicates(df: DataFrame, keys: Sequence[str], count: str = "occurrence_count") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def share_of_total(df: DataFrame, group: str, count: str = "record_count", share: str = "percentage_of_total") -> DataFrame:
    """Count per group and its percentage of all rows.

    The total is a scalar subquery, so many groups do not meet in one task.
    """
    counted = df.groupBy(group).agg(F.count(F.lit(1)).alias(count))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counted.withColumn(share, F.col(count) * 100.0 / total)


def distinct_list(df: DataFrame, keys: Sequence[str], value: str, name: str, separator: str = "; ") -> DataFrame:
    """Sorted distinct non-null texts of each key, joined. Duplicates go before values are collected."""
    pairs = df.select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(value)), separator).alias(name))


def distinct_array(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    pairs = df.select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(name))


def unit_flags(df: DataFrame, keys: Sequence[str], ids: str, units: Sequence[tuple[str, str]], suffix: str = "business_unit") -> DataFrame:
    """One boolean column per (id, name): does the key have that unit in its ';'-separated ids?

    The columns are the caller's. ``unit_members`` answers the same in rows, for a lookup of any size.
    """
    held = F.split(F.col(ids), ";")
    flags = [
        F.coalesce(F.bool_or(F.array_contains(held, str(unit))), F.lit(False)).alias(f"is_{name.lower().replace(' ', '_')}_{suffix}")
        for unit, name in units
    ]
    return df.groupBy(*keys).agg(*flags)


def unit_members(df: DataFrame, keys: Sequence[str], ids: str, units: DataFrame, unit_id: str, unit_name: str) -> DataFrame:
    """Distinct (keys, name) for every unit of the lookup among the keys' ';'-separated ids."""
    held = df.select(*keys, F.explode(F.split(F.col(ids), ";")).alias("_unit")).distinct()
    named = units.select(F.col(unit_id).cast("string").alias("_unit"), F.col(unit_name))
    return held.join(named, "_unit").select(*keys, unit_name).distinct()


def first_and_more(df: DataFrame, key: str, value: str, k: int = 5, name: str = "listing") -> DataFrame:
    """The first k values of each key as text, then 'and N more'."""
    first = first_per_key(df.select(key, value), [key], [F.col(value).asc()], k)
    listed = first.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list(value)), ", ").alias("_listed"))
    counted = df.groupBy(F.col(key).alias("_key")).agg(F.count(value).alias("_n"))
    more = F.when(F.col("_n") > k, F.concat(F.lit(", and "), (F.col("_n") - k).cast("string"), F.lit(" more")))
    return counted.join(listed, F.col(key).eqNullSafe(F.col("_key"))).select(
        key, F.concat("_listed", F.coalesce(more, F.lit(""))).alias(name), F.col("_n").alias("total")
    )


def flakiness(
    df: DataFrame, name: Column, state: str, link: Column, order: Sequence[str], kind: Column | None = None
) -> DataFrame:
    """Passes and failures per job, the first link of each outcome, flaky when both occurred."""
    jobs = df if kind is None else df.filter(kind)
    passed, failed = F.col(state) == "passed", F.col(state) == "failed"
    # The order is wrapped so that rows of the other outcome have a NULL order, which min_by skips.
    example = lambda outcome: F.min_by(link, F.when(outcome, F.struct(*order)))
    counted = jobs.groupBy(F.coalesce(name, F.lit("unknown")).alias("job_name")).agg(
        F.count_if(passed).alias("passed"),
        F.count_if(failed).alias("failed"),
        example(failed).alias("failed_example"),
        example(passed).alias("passed_example"),
    )
    flaky = (F.col("passed") > 0) & (F.col("failed") > 0)
    return counted.select(
        "job_name", "passed", "failed",
        F.when(F.col("failed") > 0, F.col("failed_example")).alias("failed_example"),
        F.when(flaky, F.col("passed_example")).alias("passed_example"),
        flaky.alias("is_flaky"),
    )


def status_breakdown(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and percent of rows per value of several status columns, NULL statuses not counted.

    Columns are counted side by side in one pass over the data. A column's total, NULL statuses included, is summed from its counts, combined before the
    shuffle, and comes back as a row for each column; the statuses themselves, however many, meet in no task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("status_column"), F.col(c).cast("string").alias("status")) for c in columns])
    counted = df.select(F.explode(pairs).alias("p")).groupBy("p.status_column", "p.status").agg(F.count(F.lit(1)).alias("n"))
    every = counted.groupBy("status_column").agg(F.sum("n").alias("_every"))  # a row for each column of the argument
    out = counted.filter(F.col("status").isNotNull()).join(F.broadcast(every), "status_column")
    return out.select("status_column", "status", "n", F.round(F.col("n") * 100.0 / F.col("_every"), 1).alias("percent"))


def optional_sums(df: DataFrame, payload: Column, fields: Sequence[str]) -> DataFrame:
    """Sums over optional numeric keys of a JSON payload; a missing key counts 0."""
    parsed = F.from_json(payload, "struct<" + ",".join(f"`{f}`:double" for f in fields) + ">")
    return df.select(parsed.alias("p")).agg(
        *[F.coalesce(F.sum(F.coalesce(F.col(f"p.{f}"), F.lit(0.0))), F.lit(0.0)).alias(f"sum_{f}") for f in fields]
    )


def idle_objects(
    objects: DataFrame, activity: DataFrame, key: str, created: str, altered: str, used: str, today: Column,
    pattern: str, min_idle: int = 14, window: int = 30,
) -> DataFrame:
    """Objects of a naming pattern without activity for more than ``min_idle`` days.

    ``activity`` has rows per use; only the last ``window`` days count, and an object without any is
    taken to be last used at the start of that window.
    """
    floor = F.date_sub(today, window)
    recent = activity.filter(F.col(used).cast("date") > floor).groupBy(key).agg(F.max(F.col(used).cast("date")).alias("_used"))
    last = F.greatest(F.col(created).cast("date"), F.col(altered).cast("date"), F.coalesce(F.col("_used"), floor))
    found = objects.filter(F.col(key).cast("string").rlike(pattern) if pattern else F.lit(True)).join(recent, key, "left")
    return (
        found.withColumn("last_activity", last)
        .withColumn("days_since_last_activity", F.datediff(today, F.col("last_activity")))
        .filter(F.col("days_since_last_activity") > min_idle)
        .select(key, "last_activity", "days_since_last_activity")
    )


def merged_metrics(metrics: Mapping[str, DataFrame], key: str, dimension: DataFrame | None = None) -> DataFrame:
    """Metric series merged by key, a missing value 0, optionally restricted to known keys."""
    out = merge_series(metrics, key)
    return out if dimension is None else dimension.join(out, key)


def daily_counts(sources: Sequence[DataFrame], at: str, name: str, day: str = "day", where: Column | None = None) -> DataFrame:
    """Rows per day over same-shaped sources."""
    parts = [(df if where is None else df.filter(where)).select(F.col(at).cast("date").alias(day)) for df in sources]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy(day).agg(F.count(F.lit(1)).alias(name))


def date_spine(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """One row per day from a start to an end date, taken from one row of dates."""
    return df.select(F.explode(F.sequence(F.col(start), F.col(end))).alias(name))
