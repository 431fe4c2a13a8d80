"""Merges, replacements, change logs and snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import dates as D
from lakeops.operators import cdc as C
from lakeops.operators import snapshots as H
from lakeops.queries.registry import query, text
from lakeops.queries.relational import money, n_rows
from lakeops.queries.scalars import NEW_ARR_SQL, deal_new_arr, deals
from lakeops.queries.views import CHANGES_SQL, changes
from lakeops.sinks import merge as M
from lakeops.sinks import tables as W
from lakeops.sinks.buckets import KeyBuckets
from lakeops.sources import increments as I

day = lambda text_date: F.lit(text_date).cast("date")


# Replacements. The batch is the last week with doubled values, the target everything before the 25th.


def _target_and_batch(t):
    rows = t.events.select("event_id", "ts", F.to_date("ts").alias("day"), F.date_trunc("hour", "ts").alias("hour"), "value")
    batch = rows.filter(F.col("ts") >= day("2024-01-23")).withColumn("value", F.col("value") * 2)
    return rows.filter(F.col("ts") < day("2024-01-25")), batch


EVENT_ROWS = """
target as (select event_id, ts, value from events where ts < date '2024-01-25'),
batch as (select event_id, ts, value * 2 as value from events where ts >= date '2024-01-23')"""


@query("w1_replace_windows", f"""with {EVENT_ROWS}
select event_id, value from target where date_trunc('hour', ts) not in (select date_trunc('hour', ts) from batch) union all select event_id, value from batch""")
def _(t):
    target, batch = _target_and_batch(t)
    return M.replace_keys(target, batch, ["day", "hour"]).select("event_id", "value")


@query("w2_replace_dates", f"""with {EVENT_ROWS}
select event_id, value from target where cast(ts as date) not in (select cast(ts as date) from batch) union all select event_id, value from batch""")
def _(t):
    target, batch = _target_and_batch(t)
    return M.replace_keys(target, batch, ["day"]).select("event_id", "value")


_RANGE = """select o_orderkey, o_totalprice from orders where not (o_orderdate >= date '1996-01-01' and o_orderdate {0} date '1997-01-01')
union all select o_orderkey + 1000000000, o_totalprice from orders where o_orderdate >= date '1996-06-01' and o_orderdate < date '1997-01-01'"""


def _replaced_orders(t, inclusive):
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    batch = rows.filter((F.col("o_orderdate") >= day("1996-06-01")) & (F.col("o_orderdate") < day("1997-01-01")))
    batch = batch.withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)
    return M.replace_range(rows, batch, "o_orderdate", day("1996-01-01"), day("1997-01-01"), inclusive).select("o_orderkey", "o_totalprice")


@query("w3_replace_range", _RANGE.format("<"))
def _(t):
    return _replaced_orders(t, False)


@query("w4_replace_range_inclusive", _RANGE.format("<="))
def _(t):
    return _replaced_orders(t, True)


@query("w5_replace_value", """
select o_orderkey, o_totalprice from orders where o_orderstatus <> 'P' union all select o_orderkey, 0.0 from orders where o_orderstatus = 'P' and o_totalprice > 100000""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    batch = rows.filter("o_orderstatus = 'P' and o_totalprice > 100000").withColumn("o_totalprice", F.lit(0.0))
    return M.replace_value(rows, batch, "o_orderstatus", F.lit("P")).drop("o_orderstatus")


@query("w6_replace_all", "select n_nationkey, upper(n_name) as n_name from nation where n_regionkey = 1")
def _(t):
    batch = t.nation.filter("n_regionkey = 1").withColumn("n_name", F.upper("n_name"))
    replaced = M.replace_all(t.nation, batch)
    emptied = M.replace_all(t.nation, batch.limit(0))  # adds nothing to the result, unless it did not empty the target
    return replaced.unionByName(emptied).select("n_nationkey", "n_name")


@query("w7_replace_if_any", "select c_custkey, c_mktsegment from customer")
def _(t):
    return M.replace_if_any(t.customer, t.customer.filter("c_nationkey < 0")).select("c_custkey", "c_mktsegment")


# Merges. The source renames a third of the customers and adds as many.


def _renamed(t):
    return t.customer.filter(F.col("c_nationkey") < 8).withColumn("c_name", F.concat("c_name", F.lit("-2")))


def _added(t):
    return _renamed(t).withColumn("c_custkey", F.col("c_custkey") + 1000000000)


@query("m1_upsert", """
select c_custkey, case when c_nationkey < 8 then c_name || '-2' else c_name end as c_name from customer
union all select c_custkey + 1000000000, c_name || '-2' from customer where c_nationkey < 8""")
def _(t):
    return M.upsert(t.customer, _renamed(t).unionByName(_added(t)), ["c_custkey"]).select("c_custkey", "c_name")


@query("m1_bucketed_upsert", """
select o_orderkey, o_orderstatus, case when o_orderstatus = 'O' then o_totalprice + 1 else o_totalprice end as o_totalprice from orders
union all select o_orderkey + 1000000000, o_orderstatus, o_totalprice + 1 from orders where o_orderstatus = 'O'""")
def _(t):
    """A bucketed table, merged twice where it lies: first the open orders at new prices, then as many new ones."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    dearer = rows.filter("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    root = t.scratch("m1")
    W.publish_bucketed(rows, root, ["o_orderkey"], 8)
    for source in (dearer, dearer.withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)):
        W.publish_bucketed(M.upsert(W.read_bucketed(t.spark, root, rows.schema, ["o_orderkey"], 8), source, ["o_orderkey"]), root, ["o_orderkey"], 8)
    return W.read_bucketed(t.spark, root, rows.schema, ["o_orderkey"], 8)


@query("m2_insert_missing", "select c_custkey, c_name from customer union all select c_custkey + 1000000000, c_name || '-2' from customer where c_nationkey < 8")
def _(t):
    return M.insert_missing(t.customer, _renamed(t).unionByName(_added(t)), ["c_custkey"]).select("c_custkey", "c_name")


@query("m3_update_payload", """
select event_id, event_type, case when event_type = 'view' or value > 30 then '{"v": 1}' else props end as props from events where event_type <> 'error'
union all select event_id, event_type, case when value > 30 then '{"v": 1}' else '{}' end from events where event_type = 'error'""")
def _(t):
    rows = t.events.select("event_id", "event_type", "props")
    payload = F.when((F.col("event_type") == "view") | (F.col("value") > 30), '{"v": 1}').otherwise("{}")
    source = t.events.withColumn("props", payload).select("event_id", F.col("event_type"), "props")
    return M.update_payload(rows.filter("event_type <> 'error'"), source, ["event_id"], "props")


@query("m4_append_evolving", "select p_partkey, p_name, null as origin from part union all select p_partkey + 1000000000, p_name, 'new' from part where p_size = 1")
def _(t):
    rows = t.part.select("p_partkey", "p_name")
    more = t.part.filter("p_size = 1").select((F.col("p_partkey") + 1000000000).alias("p_partkey"), "p_name", F.lit("new").alias("origin"))
    return M.append_evolving(rows, more)


@query("m5_append_run", "select o_orderkey, '2024-01-01 00:00:00' as predicted_at from orders union all select o_orderkey, '2024-01-02 00:00:00' from orders where o_orderstatus = 'O'")
def _(t):
    first = M.append_run(None, t.orders.select("o_orderkey"), F.lit("2024-01-01").cast("timestamp_ntz"))
    second = M.append_run(first, t.orders.filter("o_orderstatus = 'O'").select("o_orderkey"), F.lit("2024-01-02").cast("timestamp_ntz"))
    return second.select("o_orderkey", text("predicted_at"))


# Incremental reads.


@query("s14_incremental_by_key", """
with old as (select * from events where ts < date '2024-01-10'), w as (select coalesce(max(event_id), 0) as mark from old)
select event_id, event_type from old union all
(select event_id, event_type from events, w where event_id > mark and event_type <> 'error')""")
def _(t):
    old = t.events.filter(F.col("ts") < day("2024-01-10"))
    new = I.next_rows(t.events, "event_id", I.watermark(old, "event_id") or 0, 1_000_000, F.col("event_type") != "error", F.to_date("ts"))
    return old.unionByName(new).select("event_id", "event_type")


@query("s15_incremental_upsert", """
with m as (select max(o_orderdate) as mark from orders where o_orderdate < date '2000-01-01')
select o_orderkey, case when o_orderdate > mark then 'new' else 'old' end as state from orders, m""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    old = rows.filter(F.col("o_orderdate") < day("2000-01-01"))
    merged = I.incremental_upsert(
        old.withColumn("state", F.lit("old")), rows.withColumn("state", F.lit("new")), ["o_orderkey"], "o_orderdate", I.watermark(old, "o_orderdate")
    )
    return merged.select("o_orderkey", "state")


@query("s16_upsert_whole_source", "select c_custkey, upper(c_name) as c_name from customer")
def _(t):
    source = t.customer.withColumn("c_name", F.upper("c_name"))
    return M.upsert(t.customer.filter("c_acctbal > 0"), source, ["c_custkey"]).select("c_custkey", "c_name")


_UNIQUE_LINES = "select l_orderkey, l_linenumber, max(l_quantity) as q from lineitem group by 1, 2"


@query("s17_upsert_composite", f"select l_orderkey, l_linenumber, case when q > 25 then q * 2 else q end as q from ({_UNIQUE_LINES})")
def _(t):
    keys = ["l_orderkey", "l_linenumber"]
    lines = t.lineitem.groupBy(*keys).agg(F.max("l_quantity").alias("q"))
    return M.upsert(lines, lines.filter("q > 25").withColumn("q", F.col("q") * 2), keys)


@query("s18_full_refresh", "select s_suppkey, s_name from supplier")
def _(t):
    path = t.scratch("s18")
    for _ in range(2):
        t.supplier.select("s_suppkey", "s_name").write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query("s19_row_cap", "select event_id, cast(ts as varchar) as ts from events where ts > timestamp '2024-01-05' and ts <= (select max(ts) from (select ts from events where ts > timestamp '2024-01-05' order by ts limit 500))")
def _(t):
    mark = F.lit("2024-01-05").cast("timestamp_ntz")
    return I.next_rows(t.events, "ts", limit=500, where=F.col("ts") > mark, slice_by=F.to_date("ts")).select("event_id", text("ts"))


@query("s20_json_column", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def _(t):
    return I.typed_json(t.events, "props").select("event_id", F.try_variant_get("props", "$.k", "bigint").alias("k"))


@query("s21_shards", """
select case when o_orderpriority < '3' then 0 else 1 end as shard_id, count(*) as n, count(distinct o_custkey) as customers from orders group by 1""")
def _(t):
    shards = {0: t.orders.filter("o_orderpriority < '3'"), 1: t.orders.filter("o_orderpriority >= '3'")}
    return I.union_shards(shards).groupBy("shard_id").agg(n_rows("n"), F.count_distinct("o_custkey").alias("customers"))


@query("s22_cut_over", "select event_id, case when ts < date '2024-01-15' then 'old' else 'new' end as origin from events")
def _(t):
    old, new = t.events.withColumn("origin", F.lit("old")), t.events.withColumn("origin", F.lit("new"))
    return I.cut_over(old, new, "ts", day("2024-01-15").cast("timestamp_ntz")).select("event_id", "origin")


@query("s23_lookback", """
select event_id, case when ts >= timestamp '2024-01-18' then 'again' else 'old' end as origin from events
where ts >= timestamp '2024-01-18' or (ts < timestamp '2024-01-20' and event_type <> 'view')""")
def _(t):
    rows = t.events.select("event_id", "ts")
    loaded = t.events.filter("event_type <> 'view'").filter(F.col("ts") < day("2024-01-20")).select("event_id", "ts")
    merged = I.reread_lookback(
        loaded.withColumn("origin", F.lit("old")), rows.withColumn("origin", F.lit("again")), ["event_id"], "ts", F.lit("2024-01-20").cast("timestamp_ntz")
    )
    return merged.select("event_id", "origin")


@query("s24_rolling_counts", """
select cast(cast(ts as date) as varchar) as date, user_id, count(*) as user_events_count from events
where cast(ts as date) between date '2024-01-20' - 7 and date '2024-01-22' and event_type <> 'error' group by 1, 2""")
def _(t):
    pull = lambda today, seen: I.rolling_counts(seen, "ts", "user_id", day(today), where=F.col("event_type") != "error")
    # The first pull saw half of its last day; the second, two days later, counts that day anew and adds two.
    first = pull("2024-01-20", t.events.filter(F.col("ts") < F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")))
    return M.upsert(first, pull("2024-01-22", t.events), ["date", "user_id"]).withColumn("date", F.col("date").cast("string"))


# Change logs.

CURRENT_SQL = """
select user_id, event_id, event_type, value, props from changes
qualify row_number() over (partition by user_id order by ts desc, case op when 'D' then 1 else 0 end, event_id desc) = 1 and op <> 'D'"""
LOG = dict(keys=["user_id"], ts="ts", op="op", tie=["event_id"])


@query("c1_current_state", f"with {CHANGES_SQL} {CURRENT_SQL}")
def _(t):
    return C.cdc_current(changes(t), **LOG)


@query("c2_two_phase_fold", f"with {CHANGES_SQL} {CURRENT_SQL}")
def _(t):
    return C.cdc_current_two_phase(changes(t), **LOG)


@query("c3_composite_key", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, case l_returnflag when 'R' then 1 else 0 end, l_partkey desc, l_suppkey desc) = 1 and l_returnflag <> 'R'""")
def _(t):
    keys = C.key_columns("lineitem", {"lineitem": ["l_orderkey", "l_linenumber"]})
    op = F.when(F.col("l_returnflag") == "R", "D").otherwise("U")
    log = t.lineitem.select(*keys, "l_partkey", "l_suppkey", "l_shipdate", op.alias("op"))
    return C.cdc_current(log, keys, "l_shipdate", "op", ["l_partkey", "l_suppkey"])


@query("c4_incremental_fold", f"with {CHANGES_SQL} {CURRENT_SQL}")
def _(t):
    log = changes(t)
    state = C.cdc_latest(log.filter(F.col("ts") < day("2024-01-15")), **LOG)
    for late in (F.col("ts") >= day("2024-01-20"), (F.col("ts") >= day("2024-01-15")) & (F.col("ts") < day("2024-01-20"))):
        state = C.cdc_apply(state, log.filter(late), **LOG)
    return C.visible(state, "ts", "op")


BY_DAYS = ["2024-01-01", "2024-01-10", "2024-01-15", "2024-01-20", "2024-02-01"]


@query("c4_bucketed_fold", """with changes as (
  select nullif(user_id, 7) as user_id, event_id, event_type, value, props, case event_type when 'error' then 'D' when 'signup' then 'I' else 'U' end as op, ts from events)""" + CURRENT_SQL)
def _(t):
    """The log in four batches, the last two late and out of order, each folded into the stored key buckets it touches; one user has no id."""
    log = changes(t).withColumn("user_id", F.nullif("user_id", F.lit(7).cast("long")))
    table = KeyBuckets(t.spark, t.scratch("c4"), log.schema, LOG["keys"], 16)
    for version, i in enumerate([0, 1, 3, 2]):
        C.cdc_merge(table, log.filter((F.col("ts") >= day(BY_DAYS[i])) & (F.col("ts") < day(BY_DAYS[i + 1]))), version, LOG["ts"], LOG["op"], LOG["tie"])
    return C.visible(table.read(), "ts", "op")


@query("c1_text_times", """
with changes as (
  select user_id, event_id, value, case event_type when 'error' then 'D' else 'U' end as op,
    case event_id % 3 when 0 then strftime(ts, '%Y-%m-%d %H:%M:%S.%f') when 1 then strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || 'Z'
      else strftime(date_trunc('minute', ts) + interval 5 hour, '%Y-%m-%d %H:%M:%S') || '+05:00' end as stamp,
    case event_id % 3 when 0 then ts when 1 then date_trunc('second', ts) else date_trunc('minute', ts) end as moment from events)
select user_id, event_id, value, stamp from changes
qualify row_number() over (partition by user_id order by moment desc, case op when 'D' then 1 else 0 end, event_id desc) = 1 and op <> 'D'""")
def _(t):
    """Times as text of several precisions and zones, which do not sort as text."""
    zoned = lambda c, pattern, end: F.concat(F.date_format(c, pattern), F.lit(end))
    at = (
        F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(F.col("event_id") % 3 == 1, zoned("ts", "yyyy-MM-dd'T'HH:mm:ss", "Z"))
        .otherwise(zoned(F.date_trunc("minute", "ts") + F.expr("interval 5 hours"), "yyyy-MM-dd HH:mm:ss", "+05:00"))
    )
    log = t.events.select("user_id", "event_id", "value", F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"), at.alias("stamp"))
    latest = C.cdc_latest(log, ["user_id"], "stamp", "op", ["event_id"], ts_type="timestamp")
    return latest.filter("op <> 'D'").drop("op")


@query("c5_baseline", """
with changes as (
  select user_id, event_type, case event_type when 'error' then 'D' else 'U' end as op, ts, event_id from events
  union all select c_custkey, 'baseline', 'I', null, null from customer)
select user_id, event_type from changes qualify row_number() over (partition by user_id order by ts desc nulls last, event_id desc) = 1 and op <> 'D'""")
def _(t):
    baseline = t.customer.select(F.col("c_custkey").alias("user_id"), F.lit("baseline").alias("event_type"))
    return C.cdc_current(changes(t), **LOG, baseline=baseline).select("user_id", "event_type")


# Snapshots: customers on two days. On the second, nation 0-4 changed, nation 20+ is gone, and a copy of nation 5 is new.


def _days(t):
    first = t.customer.filter("c_nationkey >= 0").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    kept = first.filter("c_nationkey < 20").withColumn(
        "c_mktsegment", F.when(F.col("c_nationkey") < 5, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    )
    new = first.filter("c_nationkey = 5").withColumn("c_custkey", F.col("c_custkey") + 1000000000)
    return first, kept.unionByName(new)


VERSIONS = "cast(valid_from as varchar) as valid_from, cast(valid_to as varchar) as valid_to, is_current"


def _versions(df, *columns):
    return df.select(*columns, text("valid_from"), text("valid_to"), "is_current")


@query("h1_snapshot_timestamp", f"""
select c_custkey, segment, {VERSIONS} from (
  select c_custkey, c_mktsegment as segment, timestamp '2024-01-01' as valid_from, case when c_nationkey < 5 then timestamp '2024-01-02' end as valid_to, c_nationkey >= 5 as is_current from customer
  union all select c_custkey, null, timestamp '2024-01-02', null, true from customer where c_nationkey < 5
  union all select c_custkey + 1000000000, c_mktsegment, timestamp '2024-01-01', null, true from customer where c_nationkey = 5)""")
def _(t):
    first, second = _days(t)
    moved = F.when(F.col("c_nationkey") < 5, "2024-01-02").otherwise("2024-01-01").cast("date")
    history = H.start_history(first.withColumn("updated_at", day("2024-01-01")), day("2024-01-01").cast("timestamp_ntz"))
    for _ in range(2):
        history = H.snapshot_by_timestamp(history, second.withColumn("updated_at", moved), ["c_custkey"], "updated_at")
    return _versions(history, "c_custkey", F.col("c_mktsegment").alias("segment"))


def _checked(t, hard_deletes):
    first, second = _days(t)
    history = H.start_history(first, day("2024-01-01").cast("timestamp_ntz"))
    return H.snapshot_by_check(history, second, ["c_custkey"], ["c_mktsegment", "c_acctbal"], day("2024-01-02"), hard_deletes)


_CHECKED_SQL = """
  select c_custkey, c_mktsegment as segment, timestamp '2024-01-01' as valid_from, case when c_nationkey < 5 {0} then timestamp '2024-01-02' end as valid_to, not (c_nationkey < 5 {0}) as is_current from customer
  union all select c_custkey, null, timestamp '2024-01-02', null, true from customer where c_nationkey < 5
  union all select c_custkey + 1000000000, c_mktsegment, timestamp '2024-01-02', null, true from customer where c_nationkey = 5"""


@query("h2_snapshot_check", f"select c_custkey, segment, {VERSIONS} from ({_CHECKED_SQL.format('')})")
def _(t):
    return _versions(_checked(t, False), "c_custkey", F.col("c_mktsegment").alias("segment"))


@query("h3_hard_deletes", f"select c_custkey, segment, {VERSIONS} from ({_CHECKED_SQL.format('or c_nationkey >= 20')})")
def _(t):
    return _versions(_checked(t, True), "c_custkey", F.col("c_mktsegment").alias("segment"))


@query("h3_split_history", f"""
with p as (select nullif(p_partkey, 7) as id, p_partkey as k, p_size as size, p_brand as brand from part)
select id, size, brand, {VERSIONS} from (
  select id, size, brand, timestamp '2024-01-01' as valid_from,
    case when k % 7 = 1 then timestamp '2024-01-02' when k % 11 = 2 then timestamp '2024-01-03' end as valid_to, k % 7 <> 1 and k % 11 <> 2 as is_current from p
  union all select id, size + 1, null, timestamp '2024-01-02', case when k % 11 = 2 then timestamp '2024-01-03' end, k % 11 <> 2 from p where k % 7 = 1
  union all select id + 1000000000, size, brand, timestamp '2024-01-02', timestamp '2024-01-03', false from p where k % 5 = 0)""")
def _(t):
    """Parts over three days, stored: on the second a seventh changes, on the third an eleventh and all that the second added are gone. One part has no key."""
    rows = t.part.select(F.nullif("p_partkey", F.lit(7).cast(t.part.schema["p_partkey"].dataType)).alias("id"), F.col("p_partkey").alias("k"), F.col("p_size").alias("size"), F.col("p_brand").alias("brand"))
    moved = F.col("k") % 7 == 1
    second = rows.withColumn("size", F.when(moved, F.col("size") + 1).otherwise(F.col("size"))).withColumn("brand", F.when(~moved, F.col("brand")))
    added = rows.filter("k % 5 = 0").withColumn("id", F.col("id") + 1000000000)
    third = second.filter("k % 11 <> 2")
    schema = H.start_history(rows.drop("k"), F.lit(None).cast("timestamp_ntz")).schema
    history = H.SplitHistory(KeyBuckets(t.spark, t.scratch("h3"), schema, ["id"], 16), t.scratch("h3-closed"))
    for version, (batch, closes) in enumerate([(rows, True), (second.unionByName(added), False), (third, True), (third, True)]):
        at = day(f"2024-01-0{min(version, 2) + 1}").cast("timestamp_ntz")
        history.run(batch.drop("k"), version, H.differs(["size"]), at, at if closes else None)
    return _versions(history.read(), "id", "size", "brand")


@query("h4_expression_key", "select l_orderkey || '-' || l_linenumber as key, count(*) as n from lineitem group by 1")
def _(t):
    return t.lineitem.groupBy(H.expression_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("key")).agg(n_rows("n"))


@query("h5_surrogate_key", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, md5(concat_ws('-', l_orderkey, coalesce(nullif(l_returnflag, 'R'), '_dbt_utils_surrogate_key_null_'), l_linenumber)) as key from lineitem""")
def _(t):
    flag = F.nullif(F.col("l_returnflag"), F.lit("R"))
    key = H.surrogate_key(F.col("l_orderkey"), flag, F.col("l_linenumber"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", key.alias("key"))


@query("h7_enriched_snapshot", f"""with s as (
  select c_custkey, nullif(count(*) filter (o_orderstatus = 'F'), 0) as one, nullif(count(*) filter (o_orderstatus in ('F', 'P')), 0) as two
  from customer left join orders on c_custkey = o_custkey group by 1)
select c_custkey, score, {VERSIONS} from (
  select c_custkey, one as score, timestamp '2024-01-01' as valid_from, case when one is distinct from two then timestamp '2024-01-02' end as valid_to, one is not distinct from two as is_current from s
  union all select c_custkey, two, timestamp '2024-01-02', null, true from s where one is distinct from two)""")
def _(t):
    """Customers with a score that is looked up; on the second day more orders count."""
    def scored(states):
        scores = t.orders.filter(F.col("o_orderstatus").isin(states)).groupBy("o_custkey").agg(n_rows("score"))
        return t.customer.join(scores, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "score")

    history = H.start_history(scored(["F"]), F.lit("2024-01-01").cast("timestamp_ntz"))
    return _versions(H.snapshot_by_check(history, scored(["F", "P"]), ["c_custkey"], ["score"], day("2024-01-02")), "c_custkey", "score")


@query("h8_aggregate_snapshot", f"""{NEW_ARR_SQL},
a as (select o_orderkey, round(case
  when kind = 'Upsell' and prorated > 0 and non_prorated > 0 then annualized - prior
  when kind = 'Upsell' and prorated = 0 and non_prorated > 0 then year1 - prior
  when kind = 'New Business' then year1 when term_months % 12 = 0 then year1 - prior
  else year1 * (12.0 / (term_months % 12)) - prior end, 4) as new_arr, term_months > 24 as changed from deals)
select o_orderkey, new_arr, {VERSIONS} from (
  select o_orderkey, new_arr, timestamp '2024-01-01' as valid_from, timestamp '2024-01-02' as valid_to, false as is_current from a
  union all select o_orderkey, new_arr, timestamp '2024-01-02', null, true from a)""")
def _(t):
    rows = deals(t).select("o_orderkey", F.round(deal_new_arr(), 4).alias("new_arr"))
    at = lambda d: day(d).alias("snapshot_date")
    history = H.start_history(rows.select("*", at("2024-01-01")), F.lit("2024-01-01").cast("timestamp_ntz"))
    # A daily snapshot: the snapshot date grows, so every key gets a version per day.
    history = H.snapshot_by_timestamp(history, rows.select("*", at("2024-01-02")), ["o_orderkey"], "snapshot_date")
    return _versions(history, "o_orderkey", "new_arr")


@query("h9_active_snapshot", f"""select o_orderkey, {VERSIONS} from (
  select o_orderkey, timestamp '2024-01-01' as valid_from, case when o_totalprice > 100000 then timestamp '2024-01-02' end as valid_to, o_totalprice <= 100000 as is_current from orders where o_orderstatus = 'O'
  union all select o_orderkey, timestamp '2024-01-02', null, true from orders where o_orderstatus = 'P')""")
def _(t):
    """Open orders; on the second day the large ones are no longer active, and others have become so."""
    first = t.orders.filter("o_orderstatus = 'O'")
    second = first.filter("o_totalprice <= 100000").unionByName(t.orders.filter("o_orderstatus = 'P'"))
    columns = ["o_orderkey", "o_orderstatus"]
    history = H.start_history(first.select(*columns), F.lit("2024-01-01").cast("timestamp_ntz"))
    return _versions(H.snapshot_by_check(history, second.select(*columns), ["o_orderkey"], ["o_orderstatus"], day("2024-01-02"), True), "o_orderkey")


@query("h10_as_of", "select c_custkey, c_mktsegment as segment from customer")
def _(t):
    at = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    return H.as_of(_checked(t, True), at).select("c_custkey", F.col("c_mktsegment").alias("segment"))


@query("w8_composite_merge", f"select l_orderkey, l_linenumber, q from ({_UNIQUE_LINES})")
def _(t):
    keys = ["l_orderkey", "l_linenumber"]
    lines = t.lineitem.groupBy(*keys).agg(F.max("l_quantity").alias("q"))
    return M.upsert(lines.filter("q < 30"), lines, keys)


@query("w9_append_with_cursor", """
select event_type, count(*) as n, cast(max(ts) as varchar) as newest from events group by 1""")
def _(t):
    from lakeops.sinks.tables import append_by_type

    path, rows = t.scratch("w9"), t.events.select("event_id", "ts", "event_type")
    append_by_type(rows.filter(F.col("ts") < day("2024-01-20")), path, "event_type")
    mark = t.spark.read.parquet(path).agg(F.max("ts")).first()[0]
    append_by_type(I.next_rows(rows, "ts", mark), path, "event_type")
    loaded = t.spark.read.parquet(path)
    return loaded.groupBy("event_type").agg(n_rows("n"), F.max("ts").cast("string").alias("newest"))


# Batch windows.


def _counted(t, window, ts="ts", table="events"):
    rows = getattr(t, table).filter(D.in_window(F.col(ts), window))
    return rows.agg(n_rows("n"), F.min(ts).cast("string").alias("oldest"), F.max(ts).cast("string").alias("newest"))


def _window_sql(start, end, ts="ts", table="events"):
    return f"select count(*) as n, cast(min({ts}) as varchar) as oldest, cast(max({ts}) as varchar) as newest from {table} where {ts} >= timestamp '{start}' and {ts} < timestamp '{end}'"


def _date(value):
    from datetime import date

    return date.fromisoformat(value)


def _time(value):
    from datetime import datetime

    return datetime.fromisoformat(value)


@query("t1_daily_window", _window_sql("2024-01-10", "2024-01-11"))
def _(t):
    return _counted(t, D.daily_window(_date("2024-01-10")))


@query("t1_weekly_window", _window_sql("2024-01-08", "2024-01-15"))
def _(t):
    return _counted(t, D.weekly_window(_date("2024-01-10")))


@query("t1_monthly_window", _window_sql("1996-02-01", "1996-03-01", "o_orderdate", "orders"))
def _(t):
    return _counted(t, D.monthly_window(_date("1996-02-10")), "o_orderdate", "orders")


@query("t2_padded_window", _window_sql("2024-01-01 21:00:00", "2024-01-04"))
def _(t):
    return _counted(t, D.padded_window(*D.daily_window(_date("2024-01-02"))))


@query("t3_lookback", "select event_id, value from events where ts < timestamp '2024-01-11'")
def _(t):
    rows = t.events.select("event_id", "ts", "value")
    loaded = rows.filter(D.in_window(F.col("ts"), (None, _time("2024-01-10"))))
    fetched = rows.filter(D.in_window(F.col("ts"), D.lookback_window(*D.daily_window(_date("2024-01-10")))))
    return M.insert_missing(loaded, fetched.withColumn("value", F.col("value")), ["event_id"]).select("event_id", "value")


@query("t4_two_months", _window_sql("1996-01-01", "1996-03-01", "o_orderdate", "orders"))
def _(t):
    return _counted(t, D.previous_and_current_month(_date("1996-02-10")), "o_orderdate", "orders")


@query("t5_last_full_week", _window_sql("2024-01-08", "2024-01-15"))
def _(t):
    return _counted(t, D.last_full_week(_date("2024-01-17")))


@query("t6_backfill", _window_sql("2024-01-01", "2024-02-01"))
def _(t):
    return _counted(t, D.backfill_window(_date("2024-02-01")))


@query("t7_trailing_hours", _window_sql("2024-01-09 14:00:00", "2024-01-10 14:00:00"))
def _(t):
    return _counted(t, D.trailing_hours(_time("2024-01-10 14:35:10")))


@query("t8_new_entities", """
select distinct user_id from events where ts >= date '2024-01-18' and user_id not in (select user_id from events where ts < date '2024-01-05' and event_type = 'purchase')""")
def _(t):
    known = t.events.filter((F.col("ts") < day("2024-01-05")) & (F.col("event_type") == "purchase")).select("user_id").distinct()
    recent = t.events.filter(F.col("ts") >= F.date_sub(day("2024-01-20"), 2))
    return recent.select("user_id").distinct().join(known, "user_id", "left_anti")
