"""Projections, filters, joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.dates import seconds_between, weekly_window
from lakeops.operators import aggregates as A
from lakeops.operators import joins as J
from lakeops.operators.ordered import first_per_key, ordered_scan
from lakeops.plans.checks import found_fields
from lakeops.plans.semantic import Field, Metric, SemanticModel, classify_fields, metric_query
from lakeops.queries.registry import query, text


def money(c: Column | str, name: str) -> Column:
    """Sum of cents: exact in any order of addition, so it does not depend on partitioning."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.sum(F.round(c * 100).cast("bigint")) / 100).alias(name)


MONEY_SQL = "cast(sum(cast(round({0} * 100) as bigint)) as bigint) / 100"
n_rows = lambda name: F.count(F.lit(1)).alias(name)


@query("p1_projection", "select n_nationkey as id, n_name as label, 'EU' as region from nation")
def _(t):
    return t.nation.drop("n_regionkey").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("label"), F.lit("EU").alias("region"))


@query("p2_predicates", """
select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus = 'F'
  and o_orderdate >= date '1996-01-01' and o_orderdate < date '1997-01-01' and o_orderpriority like '%H%' and regexp_matches(o_orderpriority, '^[0-9]') and o_totalprice is not null""")
def _(t):
    rows = J.match_filter(
        t.orders, is_in={"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_custkey": []}, equals={"o_orderstatus": "F", "o_orderkey": None},
        at_least={"o_orderdate": datetime(1996, 1, 1)}, below={"o_orderdate": datetime(1997, 1, 1)},
    )
    priority = F.col("o_orderpriority")
    return rows.filter(priority.like("%H%") & priority.rlike("^[0-9]") & F.col("o_totalprice").isNotNull()).select("o_orderkey", "o_orderpriority")


@query("p3_lateral_alias", "select event_id, value * 2 as doubled, value * 2 > 50 as large from events")
def _(t):
    t.events.createOrReplaceTempView("lakeops_events")
    return t.spark.sql("select event_id, value * 2 as doubled, doubled > 50 as large from lakeops_events")


@query("p4_positive_measure", "select event_id, value from events where value > 1")
def _(t):
    return t.events.filter("value > 1").select("event_id", "value")


@query("j1_inner_join", f"select c_mktsegment, count(*) as orders, {MONEY_SQL.format('o_totalprice')} as total from orders join customer on o_custkey = c_custkey group by 1")
def _(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(n_rows("orders"), money("o_totalprice", "total"))


@query("j2_left_join", "select c_custkey, n_name from customer left join (select * from nation where n_regionkey < 3) on c_nationkey = n_nationkey")
def _(t):
    lookup = t.nation.filter("n_regionkey < 3")
    return t.customer.join(lookup, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name")


@query("j3_daily_series", """
with a as (select cast(o_orderdate as date) as day, count(*) as orders_count from orders group by 1),
b as (select cast(l_shipdate as date) as day, count(*) as lines_count from lineitem group by 1),
c as (select cast(ts as date) as day, count(*) as events_count from events group by 1)
select cast(coalesce(a.day, b.day, c.day) as varchar) as day, coalesce(orders_count, 0) as orders_count,
  coalesce(lines_count, 0) as lines_count, coalesce(events_count, 0) as events_count
from a full join b on a.day = b.day full join c on c.day = coalesce(a.day, b.day)""")
def _(t):
    series = {
        "orders_count": A.daily_counts([t.orders], "o_orderdate", "orders_count"),
        "lines_count": A.daily_counts([t.lineitem], "l_shipdate", "lines_count"),
        "events_count": A.daily_counts([t.events], "ts", "events_count"),
    }
    return J.merge_series(series, "day").orderBy(F.desc("day")).withColumn("day", F.col("day").cast("string"))


@query("j4_anti_join", "select c_custkey from customer left join (select * from orders where o_orderpriority = '1-URGENT') on c_custkey = o_custkey where o_custkey is null group by 1")
def _(t):
    return J.anti_keys(t.customer, t.orders.filter("o_orderpriority = '1-URGENT'"), "c_custkey", "o_custkey")


@query("j5_semi_join", """
select o_orderkey from orders where (o_orderkey, o_orderstatus) in (select l_orderkey, l_linestatus from lineitem where l_quantity > 40)""")
def _(t):
    large = t.lineitem.filter("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus")).distinct()
    return t.orders.join(large, ["o_orderkey", "o_orderstatus"], "left_semi").select("o_orderkey")


@query("j6_range_join", """
select p.o_orderkey, o.o_orderkey as period_key from orders p join orders o on p.o_custkey = o.o_custkey
where o.o_orderpriority = '1-URGENT' and p.o_orderpriority <> '1-URGENT' and p.o_orderdate between o.o_orderdate and o.o_orderdate + interval 200 days""")
def _(t):
    points = t.orders.filter("o_orderpriority <> '1-URGENT'").select("o_custkey", "o_orderkey", "o_orderdate")
    periods = t.orders.filter("o_orderpriority = '1-URGENT'").select(
        "o_custkey", F.col("o_orderkey").alias("period_key"), F.col("o_orderdate").alias("started"),
        (F.col("o_orderdate") + F.expr("interval 200 days")).alias("ended"),
    )
    return J.range_join(points, periods, ["o_custkey"], "o_orderdate", "started", "ended").select("o_orderkey", "period_key")


@query("j7_pattern_join", """
select p_partkey, exists (select 1 from (select distinct split_part(p_name, ' ', 1) || '%' as pattern from part where p_size > 48
  union select distinct '%' || split_part(p_name, ' ', 2) from part where p_size = 1 and p_brand = 'Brand#2') where p_name like pattern) as matched from part""")
def _(t):
    starts = t.part.filter("p_size > 48").select(F.concat(F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit("%")).alias("pattern"))
    ends = t.part.filter("p_size = 1 and p_brand = 'Brand#2'").select(F.concat(F.lit("%"), F.split_part("p_name", F.lit(" "), F.lit(2))).alias("pattern"))
    return J.matches_any_pattern(t.part, "p_name", starts.union(ends), "pattern", "matched").select("p_partkey", "matched")


@query("j7_pattern_index", """
with texts as (select p_partkey, p_name || '-' || p_partkey as name from part),
patterns as (
  select '%' || right(p_name, 3) || '-' || p_partkey % 100 as pattern from part where p_size > 40
  union all select '%' || substr(p_name, 3, 4) || '_' || '%' || p_partkey % 50 from part where p_size between 30 and 32
  union all select left(p_name, 2) || '_%_-' || p_partkey % 7 || '_' from part where p_size < 4
  union all select '%q%' union all select '__________')
select p_partkey, exists (select 1 from patterns where name like pattern) as matched from texts""")
def _(t):
    """Suffixes, pieces with wildcards between them, single letters and a bare length; about a fifth of the parts gives a pattern each."""
    key = lambda n: (F.col("p_partkey") % n).cast("string")
    rows = t.part.select("p_partkey", F.concat("p_name", F.lit("-"), F.col("p_partkey").cast("string")).alias("name"))
    some = [
        t.part.filter("p_size > 40").select(F.concat(F.lit("%"), F.right("p_name", F.lit(3)), F.lit("-"), key(100)).alias("pattern")),
        t.part.filter("p_size between 30 and 32").select(F.concat(F.lit("%"), F.substring("p_name", 3, 4), F.lit("_%"), key(50)).alias("pattern")),
        t.part.filter("p_size < 4").select(F.concat(F.left("p_name", F.lit(2)), F.lit("_%_-"), key(7), F.lit("_")).alias("pattern")),
        t.spark.createDataFrame([("%q%",), ("__________",)], "pattern string"),
    ]
    return J.matches_any_pattern(rows, "name", reduce(DataFrame.unionByName, some), "pattern", "matched").select("p_partkey", "matched")


@query("j6_hierarchical_periods", """
select e.user_id, e.event_type, count(*) as n, sum(p.o_orderkey) as orders from events e join (
  select o_orderkey, o_custkey % 20 as user_id, o_orderdate + interval 28 year as started, o_orderdate + interval 28 year + interval (o_orderkey % 900) hour as ended from orders) p
  on e.user_id % 20 = p.user_id and e.ts between p.started and p.ended group by all""")
def _(t):
    """Events inside periods of an hour to weeks of twenty keys, so every key has many of both."""
    started = (F.col("o_orderdate") + F.expr("interval 28 years")).alias("started")
    periods = t.orders.select("o_orderkey", (F.col("o_custkey") % 20).alias("k"), started).withColumn("ended", F.expr("started + make_dt_interval(0, cast(o_orderkey % 900 as int))"))
    points = t.events.select("user_id", "event_type", (F.col("user_id") % 20).alias("k"), "ts")
    met = J.range_join(points, periods, ["k"], "ts", "started", "ended", "hour", count="periods", sums={"of_event": "o_orderkey"})
    return met.groupBy("user_id", "event_type").agg(F.sum("periods").alias("n"), F.sum("of_event").alias("orders"))


@query("j8_dimension_join", """
select c_custkey, c_name, cast(coalesce(m.orders_count, 0) as bigint) as orders_count from customer
join (select o_custkey, count(*) as orders_count from orders group by 1) m on c_custkey = o_custkey""")
def _(t):
    counted = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(n_rows("orders_count"))
    return A.merged_metrics({"orders_count": counted}, "c_custkey", t.customer.select("c_custkey", "c_name"))


@query("join_salted", f"select event_type, count(*) as n from events e join (select distinct user_id from events where value > 20) using (user_id) group by 1")
def _(t):
    # A low bound so that the split path runs on small tables too.
    active = t.events.filter("value > 20").select("user_id").distinct()
    joined = J.salted_join(t.events, active, ["user_id"], F.col("event_id"), hot_rows=60, salts=8)
    return joined.groupBy("event_type").agg(n_rows("n"))


@query("a1_group_by", f"""
select l_returnflag, l_linestatus, count(*) as n, {MONEY_SQL.format('l_extendedprice')} as total, min(l_quantity) as smallest, max(l_quantity) as largest
from lineitem group by all""")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        n_rows("n"), money("l_extendedprice", "total"), F.min("l_quantity").alias("smallest"), F.max("l_quantity").alias("largest"),
    )


@query("a2_conditional_counts", """
select o_orderpriority, count(*) as total, count(*) filter (o_orderstatus = 'F') as passed, count(*) filter (o_orderstatus = 'P') as failed from orders group by 1""")
def _(t):
    status = F.col("o_orderstatus")
    return t.orders.groupBy("o_orderpriority").agg(
        n_rows("total"), F.count_if(status == "F").alias("passed"), F.count_if(status == "P").alias("failed"),
    )


@query("a3_totals_and_breakdown", """
select case when grouping(o_orderpriority) = 1 then '(all)' else o_orderpriority end as o_orderpriority, count(*) as total,
  count(*) filter (o_orderstatus = 'F') as passed, count(*) filter (o_orderstatus = 'P') as failed from orders group by rollup (o_orderpriority)""")
def _(t):
    status = F.col("o_orderstatus")
    return A.totals_and_breakdown(t.orders, "o_orderpriority", {"total": F.count(F.lit(1)), "passed": F.count_if(status == "F"), "failed": F.count_if(status == "P")})


@query("a4_having_duplicates", "select l_orderkey, l_linenumber, count(*) as occurrence_count from lineitem group by 1, 2 having count(*) > 1")
def _(t):
    return A.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("a5_count_distinct", "select o_orderstatus, count(distinct o_custkey) as customers from orders group by 1")
def _(t):
    return t.orders.groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("customers"))


@query("a6_distinct_array", "select user_id, array_to_string(list_sort(list(distinct event_type)), ',') as types from events group by 1")
def _(t):
    return A.distinct_array(t.events, ["user_id"], "event_type", "types").withColumn("types", F.array_join("types", ","))


@query("a7_distinct_list", "select r_name, string_agg(distinct n_name, '; ' order by n_name) as names from nation join region on n_regionkey = r_regionkey group by 1")
def _(t):
    return A.distinct_list(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), ["r_name"], "n_name", "names")


@query("a8_unit_flags", """
select o_custkey, bool_or(o_orderstatus = 'F' and r = 0) as is_africa_business_unit, bool_or(r = 1) as is_america_business_unit,
  bool_or(r = 2 or o_orderstatus = 'O') as is_asia_business_unit, bool_or(r = 3) as is_europe_business_unit, bool_or(r = 4) as is_middle_east_business_unit
from (select o_custkey, o_orderstatus, n_regionkey as r from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey) group by 1""")
def _(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    region = F.col("n_regionkey").cast("string")
    ids = F.when((region == "0") & (F.col("o_orderstatus") != "F"), "none").otherwise(region)
    ids = F.when(F.col("o_orderstatus") == "O", F.concat(ids, F.lit(";2"))).otherwise(ids)
    units = [(str(i), name) for i, name in enumerate(("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))]
    return A.unit_flags(rows.select("o_custkey", ids.alias("ids")), ["o_custkey"], "ids", units)


@query("a8_unit_members", """
select distinct o_custkey, r_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
join region on r_regionkey = n_regionkey or o_orderstatus = 'O' and r_regionkey = 2""")
def _(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    ids = F.concat_ws(";", F.col("n_regionkey").cast("string"), F.when(F.col("o_orderstatus") == "O", "2"))
    return A.unit_members(rows.select("o_custkey", ids.alias("ids")), ["o_custkey"], "ids", t.region, "r_regionkey", "r_name")


@query("a9_share_of_total", "select event_type, count(*) as record_count, round(count(*) * 100.0 / sum(count(*)) over (), 6) as percentage_of_total from events group by 1")
def _(t):
    return A.share_of_total(t.events, "event_type").withColumn("percentage_of_total", F.round("percentage_of_total", 6))


@query("a10_daily_and_weekly", """
select cast(cast(l_shipdate as date) as varchar) as day, cast(cast(l_shipdate as date) - cast(dayofweek(l_shipdate) as integer) as varchar) as week,
  p_name, p_brand, l_returnflag, count(*) as num_downloads
from lineitem join part on l_partkey = p_partkey where starts_with(p_name, 'red') and l_shipdate >= date '1997-01-05' and l_shipdate < date '1997-03-02' group by 1, 2, 3, 4, 5""")
def _(t):
    from datetime import date

    start, end = weekly_window(date(1997, 1, 7), starts_on_sunday=True)[0], datetime(1997, 3, 2)
    rows = J.match_filter(t.lineitem, at_least={"l_shipdate": start}, below={"l_shipdate": end})
    rows = rows.join(t.part.filter(F.col("p_name").startswith("red")), F.col("l_partkey") == F.col("p_partkey"))
    day = F.to_date("l_shipdate")
    sunday = F.date_sub(day, F.dayofweek(day) - 1)
    return rows.groupBy(day.cast("string").alias("day"), sunday.cast("string").alias("week"), "p_name", "p_brand", "l_returnflag").agg(n_rows("num_downloads"))


@query("a11_top_rows", "select p_partkey, p_retailprice from part order by p_retailprice desc, p_partkey limit 10")
def _(t):
    return t.part.select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(10)


@query("a12_first_and_more", """
with r as (select s_nationkey, s_name, row_number() over (partition by s_nationkey order by s_name) as rn, count(*) over (partition by s_nationkey) as total from supplier)
select s_nationkey, string_agg(s_name, ', ' order by s_name) filter (rn <= 2) || case when total > 2 then ', and ' || (total - 2) || ' more' else '' end as listing, total from r group by s_nationkey, total""")
def _(t):
    return A.first_and_more(t.supplier, "s_nationkey", "s_name", 2)


@query("a13_flakiness", """
with j as (select coalesce(nullif(event_type, 'error'), 'unknown') as job_name, case when value > 20 then 'passed' when value > 5 then 'failed' else 'canceled' end as state,
  'build/' || event_id as link, ts, event_id from events where event_type <> 'signup'),
g as (select job_name, count(*) filter (state = 'passed') as passed, count(*) filter (state = 'failed') as failed,
  arg_min(link, event_id) filter (state = 'failed') as failed_example, arg_min(link, event_id) filter (state = 'passed') as passed_example from j group by 1)
select job_name, passed, failed, failed_example, case when passed > 0 and failed > 0 then passed_example end as passed_example, passed > 0 and failed > 0 as is_flaky from g""")
def _(t):
    state = F.when(F.col("value") > 20, "passed").when(F.col("value") > 5, "failed").otherwise("canceled")
    jobs = t.events.withColumn("state", state)
    name, link = F.nullif(F.col("event_type"), F.lit("error")), F.concat(F.lit("build/"), F.col("event_id").cast("string"))
    return A.flakiness(jobs, name, "state", link, ["event_id"], F.col("event_type") != "signup")


@query("a14_status_breakdown", """
with u as (select 'o_orderstatus' as status_column, o_orderstatus as status from orders union all select 'o_orderpriority', nullif(o_orderpriority, '5-LOW') from orders)
select * from (select status_column, status, count(*) as n, round(count(*) * 100.0 / sum(count(*)) over (partition by status_column), 1) as percent from u group by 1, 2) where status is not null""")
def _(t):
    rows = t.orders.withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return A.status_breakdown(rows, ["o_orderstatus", "o_orderpriority"])


@query("a15_optional_sums", "select cast(sum(coalesce(cast(json_extract_string(props, '$.k') as double), 0)) as double) as sum_k, 0.0::double as sum_missing from events")
def _(t):
    return A.optional_sums(t.events, F.col("props"), ["k", "missing"])


@query("a16_idle_objects", """
with recent as (select o_custkey, max(cast(o_orderdate as date)) as used from orders where cast(o_orderdate as date) > date '2001-08-02' - 400 group by 1),
o as (select c_custkey, date '2000-01-01' + cast(c_nationkey as integer) * 20 as created, date '2000-02-01' + cast(c_nationkey as integer) * 10 as altered from customer where regexp_matches(cast(c_custkey as varchar), '^[0-9]+$')),
a as (select c_custkey, greatest(created, altered, coalesce(used, date '2001-08-02' - 400)) as last_activity from o left join recent on c_custkey = o_custkey)
select c_custkey, cast(last_activity as varchar) as last_activity, cast(date '2001-08-02' - last_activity as integer) as days_since_last_activity from a where date '2001-08-02' - last_activity > 140""")
def _(t):
    day = lambda start, factor: F.date_add(F.lit(start).cast("date"), (F.col("c_nationkey") * factor).cast("int"))
    objects = t.customer.select("c_custkey", day("2000-01-01", 20).alias("created"), day("2000-02-01", 10).alias("altered"))
    used = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    rows = A.idle_objects(objects, used, "c_custkey", "created", "altered", "o_orderdate", F.lit("2001-08-02").cast("date"), "^[0-9]+$", 140, 400)
    return rows.withColumn("last_activity", F.col("last_activity").cast("string"))


@query("a17_merged_metrics", """
select user_id, count(*) filter (event_type = 'click') as clicks, count(*) filter (event_type = 'purchase' and value > 30) as large_purchases
from events where event_type = 'click' or (event_type = 'purchase' and value > 30) group by 1""")
def _(t):
    counted = lambda where, name: t.events.filter(where).groupBy("user_id").agg(n_rows(name))
    return A.merged_metrics({"clicks": counted("event_type = 'click'", "clicks"), "large_purchases": counted("event_type = 'purchase' and value > 30", "large_purchases")}, "user_id")


ORDERS_MODEL = SemanticModel(
    "orders",
    (
        Field("order_id", "o_orderkey"), Field("account_id", "o_custkey"), Field("order_month", "trunc(o_orderdate, 'month')", is_time=True),
        Field("status", "o_orderstatus", synonyms=("state",)), Field("is_urgent", "o_orderpriority = '1-URGENT'"),
        Field("cents", "cast(round(o_totalprice * 100) as bigint)"),
    ),
    (
        Metric("total_cents", "sum", "cents", ("revenue",)), Metric("account_count", "count_distinct", "account_id", ("number of customers",)),
        Metric("order_count", "count_distinct", "order_id"),
    ),
    ("order_id",),
)


@query("a18_metric_query", """
select o_orderstatus as status, o_orderpriority = '1-URGENT' as is_urgent, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as total_cents,
  count(distinct o_custkey) as account_count from orders where o_orderdate >= date '1997-01-01' group by 1, 2""")
def _(t):
    return metric_query(t.orders, ORDERS_MODEL, ["revenue", "number of customers"], ["state", "is_urgent"], F.col("o_orderdate") >= F.lit("1997-01-01").cast("date"))


@query("a19_field_classes", """
with f as (
  select * from (values ('l_orderkey', false, true), ('l_linenumber', false, true), ('l_part_id', false, false), ('l_suppkey', false, false), ('l_quantity', false, false),
    ('l_extendedprice', false, false), ('is_returned', false, false), ('l_returnflag', false, false), ('l_shipdate', true, false)) v(name, is_time, in_key)),
n as (select count(*) as n, count(*) filter (l_returnflag = 'R') as returned from lineitem)
select name, case when name in ('l_quantity', 'l_extendedprice') then 'fact' else 'dimension' end as field_class, case when name = 'is_returned' then returned else n end as n_rows from f, n""")
def _(t):
    """The fields that the lines have as records, found in the rows, and metrics over some of them: numbers that are keys, ids or flags are no facts."""
    line = F.struct(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("l_part_id"), "l_suppkey", "l_quantity", "l_extendedprice",
        F.when(F.col("l_returnflag") == "R", 1).alias("is_returned"), "l_returnflag", F.col("l_shipdate").cast("string").alias("l_shipdate"),
    )
    found = found_fields(t.lineitem.select(F.to_json(line).alias("record")), "record")
    name = F.col("column_name").alias("name")
    fields = found.groupBy(name).agg(F.sum("n_rows").alias("n_rows")).select(
        "name", "n_rows", F.col("name").endswith("date").alias("is_time"), F.col("name").isin("l_orderkey", "l_linenumber").alias("in_key")
    )
    metrics = found.filter(F.col("actual").isin("integer", "decimal") & ~F.col("column_name").endswith("suppkey")).select(F.col("column_name").alias("field"))
    return classify_fields(fields, metrics).select("name", "field_class", "n_rows")


@query("a20_reconciliation", """
with shards as (select cast(ts as date) as day from events where event_type = 'purchase' and user_id < 70 union all select cast(ts as date) from events where event_type = 'purchase' and user_id >= 70),
a as (select day, count(*) as source_count from shards group by 1),
b as (select cast(ts as date) as day, count(*) as copied_count from events where event_type = 'purchase' and value > 1 group by 1)
select case when grouping(day) = 1 then 'total' else cast(day as varchar) end as day, cast(sum(source_count) as bigint) as source_count, cast(sum(copied_count) as bigint) as copied_count
from (select coalesce(a.day, b.day) as day, coalesce(source_count, 0) as source_count, coalesce(copied_count, 0) as copied_count from a full join b on a.day = b.day) group by rollup (day)""")
def _(t):
    bought = F.col("event_type") == "purchase"
    shards = [t.events.filter("user_id < 70"), t.events.filter("user_id >= 70")]
    series = {
        "source_count": A.daily_counts(shards, "ts", "source_count", where=bought),
        "copied_count": A.daily_counts([t.events.filter("value > 1")], "ts", "copied_count", where=bought),
    }
    merged = J.merge_series(series, "day").withColumn("day", F.col("day").cast("string"))
    return A.totals_and_breakdown(merged, "day", {n: F.sum(n) for n in series}, "total")


@query("n1_newest_per_key", "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1")
def _(t):
    return first_per_key(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("n2_lag_over_days", """
select cast(day as varchar) as day, n, lag(n) over (order by day) as prior from (select cast(o_orderdate as date) as day, count(*) as n from orders group by 1)""")
def _(t):
    daily = A.daily_counts([t.orders], "o_orderdate", "n")
    # One row per day: bounded by the calendar, not by the orders.
    prior = F.lag("n").over(Window.partitionBy(F.lit(1)).orderBy("day"))
    return daily.withColumn("prior", prior).withColumn("day", F.col("day").cast("string"))


def _scan(t, **what):
    rows = t.orders.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    return ordered_scan(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.year("o_orderdate"), **what)


CENTS_SQL = "cast(round(o_totalprice * 100) as bigint)"


@query("n3_running_sum", f"select o_orderkey, cast(sum({CENTS_SQL}) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding) as bigint) as running from orders")
def _(t):
    return _scan(t, running={"running": "cents"}).select("o_orderkey", "running")


@query("n4_prior_rows", f"select o_orderkey, cast(coalesce(sum({CENTS_SQL}) over (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding), 0) as bigint) as prior from orders")
def _(t):
    return _scan(t, before={"prior": "cents"}).select("o_orderkey", "prior")


@query("n5_following_rows", f"select o_orderkey, cast(coalesce(sum({CENTS_SQL}) over (partition by o_custkey order by o_orderdate, o_orderkey rows between 1 following and unbounded following), 0) as bigint) as later from orders")
def _(t):
    return _scan(t, after={"later": "cents"}).select("o_orderkey", "later")


@query("n6_partition_count", "select event_id, count(*) over (partition by user_id) as user_events, row_number() over (partition by user_id order by ts, event_id) as rn, lag(event_id) over (partition by user_id order by ts, event_id) as previous from events")
def _(t):
    rows = ordered_scan(t.events, ["user_id"], ["ts", "event_id"], F.to_date("ts"), total="user_events", row_number="rn", lag={"previous": "event_id"})
    return rows.select("event_id", "user_events", "rn", "previous")


@query("o1_sort_limit", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("u1_union_all", "select o_orderkey as id, 'order' as kind from orders union all select event_id, 'event' from events")
def _(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), F.lit("order").alias("kind")).unionByName(
        t.events.select(F.lit("event").alias("kind"), F.col("event_id").alias("id"))
    )


@query("u2_distinct", "select distinct cast(cast(o_orderdate as date) as varchar) as day from orders")
def _(t):
    return t.orders.select(F.to_date("o_orderdate").cast("string").alias("day")).distinct()


@query("u3_difference", "select distinct c_custkey as id from customer except select o_custkey from orders where o_orderstatus = 'F'")
def _(t):
    return J.anti_keys(t.customer.select(F.col("c_custkey").alias("id")), t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id")), "id")


@query("g1_date_spine", "select cast(unnest(generate_series(min(cast(ts as date)), max(cast(ts as date)), interval 1 day)) as date)::varchar as day from events")
def _(t):
    bounds = t.events.agg(F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last"))
    return A.date_spine(bounds, "first", "last", "day").withColumn("day", F.col("day").cast("string"))
