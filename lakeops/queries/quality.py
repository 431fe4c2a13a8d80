"""Data-quality checks. Inputs are shaped so that every check has something to find."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeops.plans import checks as Q
from lakeops.queries.registry import query, text

day = lambda text_date: F.lit(text_date).cast("date")


@query("q1_is_numeric", "select p_type || p_size as numeric_field from part union all select null from part where p_size = 1")
def _(t):
    number = F.when(F.col("p_size") == 1, F.lit(None)).otherwise(F.col("p_retailprice").cast("string"))
    rows = t.part.select(number.alias("v")).union(t.part.select(F.concat("p_type", F.col("p_size").cast("string"))))
    return Q.not_numeric(rows, "v")


@query("q2_accepted_values", "select split_part(replace(o_orderpriority, '-', '_'), '_', 1) as base_plan_type from orders where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def _(t):
    return Q.unexpected_values(t.orders.withColumn("plan", F.replace("o_orderpriority", F.lit("-"), F.lit("_"))), "plan", ["1", "2", "3"])


@query("q3_nested_duplicates", """
select conv_id, turn, role as speaker_id, s as sentence_text, count(*) as occurrence_count
from (select conv_id, turn, role, unnest(string_split(text, ' ')) as s from conversations) group by all having count(*) > 1""")
def _(t):
    spoken = F.transform(F.split("text", " "), lambda s: F.struct(F.col("role").alias("speaker_id"), s.alias("text")))
    rows = t.conversations.withColumn("sentences", spoken)
    fields = {"speaker_id": F.col("e.speaker_id"), "sentence_text": F.col("e.text")}
    return Q.nested_duplicates(rows, ["conv_id", "turn"], "sentences", fields)


@query("q4_orphan_keys", "select distinct o_custkey from orders where o_custkey not in (select c_custkey from customer where c_nationkey <> 3)")
def _(t):
    return Q.orphan_keys(t.orders, t.customer.filter("c_nationkey <> 3"), "o_custkey", "c_custkey")


_SPARSE = "(select * from events where dayofmonth(ts) not in (9, 17) and (dayofmonth(ts) <> 20 or value > 20))"


def _sparse(t):
    number = F.dayofmonth("ts")
    return t.events.filter(~number.isin(9, 17) & ((number != 20) | (F.col("value") > 20)))


@query("q5_missing_dates", f"""
select cast(cast(d as date) as varchar) as missing_snapshot_date from unnest(generate_series(date '2024-01-01', date '2024-01-30', interval 1 day)) g(d)
where cast(d as date) not in (select cast(ts as date) from {_SPARSE})""")
def _(t):
    rows = Q.missing_dates(_sparse(t), "ts", day("2024-02-01"))
    return rows.select(text("missing_snapshot_date"))


@query("q6_count_drops", f"""
with d as (select cast(ts as date) as snapshot_date, count(*) as row_count from {_SPARSE} where cast(ts as date) between date '2024-01-01' and date '2024-01-30' group by 1),
p as (select *, lag(row_count) over (order by snapshot_date) as prior_row_count from d)
select cast(snapshot_date as varchar) as snapshot_date, row_count, prior_row_count, round((prior_row_count - row_count) / prior_row_count * 100, 1) as pct_drop
from p where row_count < prior_row_count * 0.85""")
def _(t):
    rows = Q.count_drops(_sparse(t), "ts", day("2024-02-01"))
    return rows.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


@query("q7_conflicting_mapping", """
select o_custkey as organization_id, o_orderkey as contract_id, l_suppkey as mapped_id from orders join
  (select l_orderkey, case when max(l_suppkey) > 20 then max(l_suppkey) end as l_suppkey from lineitem group by 1) on o_orderkey = l_orderkey where l_suppkey is not null and cast(l_suppkey as varchar) <> cast(o_custkey as varchar)""")
def _(t):
    facts = t.orders.select(F.col("o_custkey").alias("organization_id"), F.col("o_orderkey").alias("contract_id"))
    newest = F.max("l_suppkey")
    mapping = t.lineitem.groupBy(F.col("l_orderkey").alias("contract_id")).agg(F.when(newest > 20, newest).alias("mapped_id"))
    return Q.conflicting_mapping(facts, mapping, "contract_id", "organization_id", "mapped_id")


@query("q8_fallback_coverage", """
select distinct o_orderkey as contract_id, o_custkey as account_id from orders join customer on o_custkey = c_custkey
where c_acctbal > 0 and o_orderstatus <> 'F' and o_orderkey not in (select l_orderkey from lineitem where l_quantity > 45) and o_orderkey not in (select l_orderkey from lineitem where l_discount > 0.05)""")
def _(t):
    signal = F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus"))
    contracts = t.orders.select(F.col("o_orderkey").alias("contract_id"), F.col("o_custkey").alias("account_id"), signal.alias("own_organization"))
    accounts = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("account_id"))
    of = lambda where: t.lineitem.filter(where).select(F.col("l_orderkey").alias("contract_id"))
    return Q.uncovered_fallback(contracts, accounts, of("l_quantity > 45"), of("l_discount > 0.05"), "own_organization")


@query("q9_excessive_share", """
select n as record_count, round(n * 100.0 / total, 2) as percentage_of_total,
  case when n > 100000000 then 'High volume threshold exceeded (>100000000 records)' else 'High percentage threshold exceeded (>5% of total)' end as failure_reason
from (select count(*) filter (event_type = 'error') as n, count(*) as total from events where ts >= date '2024-01-24')
where n > 100000000 or n * 100.0 / total > 5""")
def _(t):
    return Q.excessive_share(t.events.filter(F.col("ts") >= day("2024-01-24")), "event_type", "error", max_rows=100_000_000)


@query("q10_missing_value", "select o_orderkey, c_custkey from orders join customer on o_custkey = c_custkey where c_mktsegment <> 'BUILDING' and o_orderstatus <> 'F' and o_totalprice <= 20000")
def _(t):
    rows = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus", F.when(F.col("o_totalprice") > 20000, "x").alias("stripe_id"))
    where = (F.col("c_mktsegment") != "BUILDING") & (F.col("o_orderstatus") != "F")
    return Q.missing_value(rows, t.customer, "c_custkey", "stripe_id", where).select("o_orderkey", "c_custkey")


@query("q11_low_share_days", """
select cast(cast(ts as date) as varchar) as date_day, count(event_id) as total, count(*) filter (value > 200) as flagged,
  round(count(*) filter (value > 200) * 100.0 / count(event_id), 2) as percent_flagged from events group by 1 having percent_flagged <= 1.0""")
def _(t):
    rows = Q.low_share_days(t.events, F.to_date("ts"), F.col("value") > 200, "event_id")
    return rows.withColumn("date_day", F.col("date_day").cast("string"))


@query("q12_not_unique", "select o_custkey, o_orderpriority, count(*) as duplicate_count from orders group by 1, 2 having count(*) > 1")
def _(t):
    return Q.not_unique(t.orders, ["o_custkey", "o_orderpriority"])


@query("q13_empty_table", "select 0::bigint as row_count where not exists (select 1 from events where value < 0)")
def _(t):
    return Q.empty_table(t.events.filter("value < 0"))


@query("q14_count_mismatch", "select count(*) as rows_read, count(*) filter (o_orderstatus <> 'P') as rows_written from orders")
def _(t):
    return Q.count_mismatch(t.orders, t.orders.filter("o_orderstatus <> 'P'"))


@query("q15_not_matching", "select p_partkey, p_brand from part where p_size <> 7 and not regexp_matches(p_brand, '^Brand#1[0-9]?$')")
def _(t):
    return Q.not_matching(t.part, "p_brand", "^Brand#1[0-9]?$", F.col("p_size") == 7).select("p_partkey", "p_brand")


@query("q16_stale", "select cast(max(ts) as varchar) as last_updated from events where event_type = 'purchase'")
def _(t):
    bought = t.events.filter("event_type = 'purchase'")
    return Q.stale(bought, "ts", F.lit("2024-02-01").cast("timestamp_ntz"), "9 hours").select(text("last_updated"))


@query("q17_schema_contract", """
with j as (select json_object('c_custkey', case when c_nationkey = 3 then to_json(c_custkey || '') else to_json(c_custkey) end, 'c_name', c_name, 'c_nationkey', c_nationkey,
    'c_balance', case when c_acctbal > 0 then c_acctbal end, 'c_extra', case when c_nationkey < 2 then c_nationkey > 0 end) as j from customer),
f as (select unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_balance', 'c_extra']) as column_name),
t as (select column_name, case json_type(j, '$.' || column_name) when 'VARCHAR' then 'text' when 'DOUBLE' then 'decimal' when 'BOOLEAN' then 'boolean' when 'NULL' then null else 'integer' end as actual from j, f),
g as (select column_name, actual, count(*) as n_rows from t where actual is not null group by all),
c as (select * from (values ('c_custkey', 'integer'), ('c_name', 'text'), ('c_nationkey', 'integer'), ('c_balance', 'decimal'), ('c_phone', 'text')) v(column_name, expected))
select column_name, expected, actual, n_rows from g left join c using (column_name) where actual is distinct from expected
union all select column_name, expected, null, n - held from (select column_name, expected, coalesce(sum(n_rows), 0) as held, (select count(*) from j) as n from c left join g using (column_name) group by all) where held < n""")
def _(t):
    """Customers as JSON records: one nation sends its keys as text, debts are left out, two nations send a field too much, and nobody the phone."""
    nation = F.col("c_nationkey")
    record = F.to_json(F.struct(
        F.when(nation != 3, F.col("c_custkey")).alias("c_custkey"), "c_name", "c_nationkey",
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("c_balance"), F.when(nation < 2, nation > 0).alias("c_extra"),
    ))
    as_text = F.regexp_replace(record, r"^\{", F.concat(F.lit('{"c_custkey":"'), F.col("c_custkey").cast("string"), F.lit('",')))
    records = t.customer.select(F.when(nation == 3, as_text).otherwise(record).alias("record"))
    contract = t.spark.createDataFrame([("c_custkey", "integer"), ("c_name", "text"), ("c_nationkey", "integer"), ("c_balance", "decimal"), ("c_phone", "text")], "column_name string, expected string")
    return Q.contract_violations(records, "record", contract)


@query("q18_missing_descriptions", """
select 'table_' || n_nationkey as table_name, case when n_regionkey = 1 then ' ' end as description from nation where n_regionkey in (1, 2) and n_nationkey <> 2""")
def _(t):
    described = F.when(F.col("n_regionkey") == 1, " ").when(F.col("n_regionkey") > 2, "text").when(F.col("n_regionkey") == 0, "text")
    name = F.concat(F.lit("table_"), F.col("n_nationkey").cast("string"))
    metadata = t.nation.select(name.alias("table_name"), described.alias("description"), F.when(F.col("n_nationkey") == 2, "STAGING_A").alias("schema_name"))
    return Q.missing_descriptions(metadata, "description", F.col("schema_name").like("STAGING%")).drop("schema_name")


@query("q19_identifier_guard", """
select n_name, n_regionkey = 3 and not contains(n_name, ' ') as safe from nation where n_regionkey >= 0""")
def _(t):
    """Names with a command after them, a digit before them, a line end or nothing at all are not safe; plain ones are."""
    name = F.when(F.col("n_regionkey") == 0, F.concat("n_name", F.lit(";drop"))).when(F.col("n_regionkey") == 1, F.concat(F.lit("1"), "n_name"))
    name = name.when(F.col("n_regionkey") == 2, F.concat("n_name", F.lit("\n"))).when(F.col("n_regionkey") == 3, F.col("n_name"))
    return t.nation.select("n_name", Q.is_safe_identifier(name).alias("safe"))


@query("q20_check_runner", """
select 'orders unique' as check_name, true as passed, 'ERROR' as severity, 0::bigint as failing_rows
union all select 'customers with a segment', count(*) = 0, 'WARN', count(*) from customer where c_mktsegment = 'BUILDING'
union all select 'urgent orders known', count(*) = 0, 'ERROR', count(*) from (select distinct o_custkey from orders where o_custkey not in (select c_custkey from customer where c_nationkey <> 3))""")
def _(t):
    return Q.run_checks([
        Q.Check("orders unique", Q.not_unique(t.orders, ["o_orderkey"])),
        Q.Check("customers with a segment", Q.not_matching(t.customer, "c_mktsegment", "^(?!BUILDING)"), "WARN"),
        Q.Check("urgent orders known", Q.orphan_keys(t.orders, t.customer.filter("c_nationkey <> 3"), "o_custkey", "c_custkey")),
    ])


@query("q20_one_pass_rules", """
with o as (select *, replace(o_orderpriority, '-', '_') as plan from orders),
r as (
  select 1 as i, 'plan is known' as check_name, 'ERROR' as severity, count(*) filter (split_part(plan, '_', 1) not in ('1', '2', '3')) as n, min(o_orderkey) filter (split_part(plan, '_', 1) not in ('1', '2', '3')) as k from o
  union all select 2, 'status is a number', 'WARN', count(*) filter (try_cast(o_orderstatus as decimal(38, 9)) is null), min(o_orderkey) filter (try_cast(o_orderstatus as decimal(38, 9)) is null) from o
  union all select 3, 'priority is upper case', 'ERROR', count(*) filter (not regexp_matches(o_orderpriority, '^[0-9]-[A-Z ]+$')), min(o_orderkey) filter (not regexp_matches(o_orderpriority, '^[0-9]-[A-Z ]+$')) from o
  union all select 4, 'urgent orders are open', 'ERROR', count(*) filter (o_orderpriority = '1-URGENT' and o_orderstatus <> 'O'), min(o_orderkey) filter (o_orderpriority = '1-URGENT' and o_orderstatus <> 'O') from o
  union all select 5, 'prices are positive', 'ERROR', count(*) filter (o_totalprice <= 0), min(o_orderkey) filter (o_totalprice <= 0) from o
  union all select 6, 'large orders have a clerk', 'WARN', count(*) filter (o_totalprice > 400000), min(o_orderkey) filter (o_totalprice > 400000) from o
  union all select 7, 'has rows', 'WARN', (count(*) = 0)::int, null from o
  union all select 8, 'is fresh', 'ERROR', (max(o_orderdate) < timestamp '2030-01-01' - interval 9 hour)::int, null from o
  union all select 9, 'few are failed', 'ERROR', (count(*) filter (o_orderstatus = 'F') > 1000000000 or count(*) filter (o_orderstatus = 'F') * 100.0 > count(*) * 5)::int, null from o
  union all select 10, 'few are pending', 'ERROR', (count(*) filter (o_orderstatus = 'P') > 1000000000 or count(*) filter (o_orderstatus = 'P') * 100.0 > count(*) * 90)::int, null from o)
select check_name, n = 0 as passed, severity, cast(n as bigint) as failing_rows, cast(k as varchar) as example from r""")
def _(t):
    """Ten rules over the orders in one pass."""
    orders = t.orders.withColumn("plan", F.replace("o_orderpriority", F.lit("-"), F.lit("_")))
    rows = Q.run_rules(orders, order_rules(), "o_orderkey", samples=1)
    return rows.select("check_name", "passed", "severity", "failing_rows", F.get("sample_keys", F.lit(0)).alias("example"))


def order_rules() -> list[Q.Rule]:
    return [
        Q.accepted_rule("plan is known", "plan", ["1", "2", "3"]),
        Q.numeric_rule("status is a number", "o_orderstatus", "WARN"),
        Q.matching_rule("priority is upper case", "o_orderpriority", "^[0-9]-[A-Z ]+$"),
        Q.Rule("urgent orders are open", (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") != "O")),
        Q.Rule("prices are positive", F.col("o_totalprice") <= 0),
        Q.Rule("large orders have a clerk", F.col("o_totalprice") > 400_000, "WARN"),
        Q.filled_rule("has rows"),
        Q.fresh_rule("is fresh", "o_orderdate", F.lit("2030-01-01").cast("timestamp_ntz"), "9 hours"),
        Q.share_rule("few are failed", F.col("o_orderstatus") == "F", 1_000_000_000),
        Q.share_rule("few are pending", F.col("o_orderstatus") == "P", 1_000_000_000, 90.0),
    ]
