"""Streaming queries: the table is the stream, one available-now run, the result read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators.sessions import merge_sessions
from lakeops.queries.files import EVENTS_BY_DAY
from lakeops.queries.history import CURRENT_SQL, LOG
from lakeops.queries.registry import query, text
from lakeops.queries.relational import n_rows
from lakeops.queries.sessions import NUMBERED_SQL
from lakeops.queries.views import CHANGES_SQL
from lakeops.streaming import jobs as R


def _zoned(df, column="ts"):
    return df.withColumn(column, F.col(column).cast("timestamp"))


def _written(t, label, writer):
    """Run a stream into parquet and read the result."""
    target = t.scratch(f"{label}-out")
    R.run_available(
        writer.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", t.scratch(f"{label}-ledger"))
    )
    return t.spark.read.parquet(target)


@query("r1_stream_to_table", EVENTS_BY_DAY)
def _(t):
    target, ledger = t.scratch("r1"), t.scratch("r1-ledger")
    for _ in range(2):  # the second run finds nothing new
        R.append_to_table(t.stream("events"), target, ledger)
    loaded = t.spark.read.parquet(target)
    return loaded.groupBy(F.to_date("ts").cast("string").alias("day")).agg(n_rows("n"), F.count_distinct("user_id").alias("users"))


@query("r2_stream_current_state", f"with {CHANGES_SQL} {CURRENT_SQL}")
def _(t):
    op = F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I").otherwise("U")
    log = t.stream("events").select("user_id", "event_id", "event_type", "value", "props", op.alias("op"), "ts")
    state = R.FoldedLog(t.scratch("r2"), log.schema, **LOG)
    R.fold_change_log(log, state, t.scratch("r2-ledger"))
    return R.current_state(t.spark, state)


def _mark(t):
    """Where the watermark stands when all events are read."""
    return t.events.agg(F.date_trunc("second", F.max(F.col("ts").cast("timestamp"))) - F.expr("interval 48 hours")).scalar()


@query("r3_stream_sessions", f"""with {NUMBERED_SQL},
s as (select user_id, session_number, min(ts) as session_start_at, max(ts) as session_end_at, count(*) as views from sessioned group by 1, 2)
select user_id, cast(session_start_at as varchar) as session_start_at, cast(session_end_at as varchar) as session_end_at, views from s""")
def _(t):
    """Closed sessions from the stream, and those that still wait for late rows from the table of its rows."""
    closed = _written(t, "r3", R.stream_sessions(_zoned(t.stream("events")), "user_id", "ts").writeStream)
    sessions = closed.unionByName(R.open_sessions(_zoned(t.events), "user_id", "ts", _mark(t)))
    return sessions.select("user_id", text("session_start_at"), text("session_end_at"), "views")


@query("r3_unknown_visitors", """
with v as (select case when user_id % 3 > 0 then user_id end as visitor, ts, event_id from events),
n as (select *, case when date_diff('second', lag(ts) over (partition by visitor order by ts, event_id), ts) <= 1800 then 0 else 1 end as fresh from v),
s as (select *, sum(fresh) over (partition by visitor order by ts, event_id rows unbounded preceding) as number from n)
select visitor, cast(min(ts) as varchar) as session_start_at, cast(max(ts) as varchar) as session_end_at, count(*) as views from s group by visitor, number""")
def _(t):
    """A third of the events has no visitor: dealt to sixteen state keys, their sessions merged."""
    viewed = lambda df: _zoned(df).withColumn("visitor", F.when(F.col("user_id") % 3 > 0, F.col("user_id")))
    salt = F.when(F.col("visitor").isNull(), F.pmod(F.xxhash64("event_id"), F.lit(16))).otherwise(0).cast("int")
    closed = _written(t, "r3u", R.stream_sessions(viewed(t.stream("events")), "visitor", "ts", salt=salt).writeStream)
    parts = closed.unionByName(R.open_sessions(viewed(t.events), "visitor", "ts", _mark(t), salt=salt, closed=closed))
    return merge_sessions(parts, "visitor").select("visitor", text("session_start_at"), text("session_end_at"), "views")


@query("r4_stream_deduplicated", EVENTS_BY_DAY)
def _(t):
    twice = _zoned(t.stream("events")).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = _written(t, "r4", R.without_duplicates(twice, ["event_id"], "ts").writeStream)
    return once.groupBy(F.to_date("ts").cast("string").alias("day")).agg(n_rows("n"), F.count_distinct("user_id").alias("users"))


_LAG_SQL = """
select case when h < 6 then '<6h' when h < 12 then '6-12h' when h < 24 then '12-24h' when h < 48 then '24-48h' when h < 168 then '2-7d' else '>7d' end as lag_bucket, count(*) as row_count
from (select cast(json_extract_string(props, '$.k') as bigint) * 2 as h from events) group by 1"""


def _landing(rows):
    hours = F.get_json_object("props", "$.k").cast("int") * 2
    return rows.withColumn("landed_at", F.col("ts") + F.make_dt_interval(F.lit(0), hours))


@query("r5_landing_lag", _LAG_SQL)
def _(t):
    return R.landing_lag(_landing(t.events), "ts", "landed_at")


@query("r5_stream_landing_lag", _LAG_SQL)
def _(t):
    name = "lakeops_landing_lag"
    counted = R.landing_lag(_landing(t.stream("events")), "ts", "landed_at")
    # Six rows at most, so the complete result fits the memory sink.
    R.run_available(counted.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", t.scratch("r5-ledger")))
    return t.spark.table(name)


_HOURS_SQL = """
select cast(date_trunc('hour', ts) as varchar) as starting_at, cast(date_trunc('hour', ts) + interval 1 hour as varchar) as ending_at, event_type, count(*) as n from events {0} group by 1, 2, 3"""


def _hours(df):
    return df.select(text("starting_at"), text("ending_at"), "event_type", "n")


@query("r6_hourly_usage", _HOURS_SQL.format(""))
def _(t):
    return _hours(R.windowed_usage(_zoned(t.events), "ts", "1 hour", ["event_type"]))


@query("r6_stream_hourly_usage", _HOURS_SQL.format(""))
def _(t):
    """Closed hours from the stream, and the last 48 from the table of its rows."""
    closed = _written(t, "r6", R.windowed_usage(_zoned(t.stream("events")), "ts", "1 hour", ["event_type"], lateness="48 hours").writeStream)
    mark = t.events.agg(F.max(F.col("ts").cast("timestamp")) - F.expr("interval 48 hours")).scalar()
    late = _zoned(t.events).filter(F.date_trunc("hour", "ts") + F.expr("interval 1 hour") > mark)
    return _hours(closed.unionByName(R.windowed_usage(late, "ts", "1 hour", ["event_type"])))


@query("r7_refresh_metrics", "select 'INCREMENTAL' as action, count(*) as rows from events")
def _(t):
    metrics = t.scratch("r7-metrics")
    R.append_with_metrics(t.stream("events"), t.scratch("r7"), metrics, t.scratch("r7-ledger"))
    return R.refresh_metrics(t.spark, metrics).filter("rows > 0").groupBy("action").agg(F.sum("rows").alias("rows"))
