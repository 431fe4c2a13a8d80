"""File sources and sinks. Files are written by Spark from the test tables into a shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.queries.registry import query, text
from lakeops.queries.relational import MONEY_SQL, money, n_rows
from lakeops.sinks import tables as W
from lakeops.sources import files as S

day = lambda text_date: F.lit(text_date).cast("date")
EVENTS_BY_DAY = "select cast(cast(ts as date) as varchar) as day, count(*) as n, count(distinct user_id) as users from events group by 1"


def _by_day(df, at="day"):
    return df.groupBy(F.col(at).cast("string").alias("day")).agg(n_rows("n"), F.count_distinct("user_id").alias("users"))


def _landed(t, label, fmt="parquet", levels=("day",), rows=None):
    """Events in dated folders; returns the root."""
    root = t.scratch(label)
    rows = t.events if rows is None else rows
    rows.withColumn("day", F.to_date("ts").cast("string")).write.mode("overwrite").format(fmt).partitionBy(*levels).save(root)
    return root


@query("s1_parquet_schema_sample", f"select l_returnflag, count(*) as n, {MONEY_SQL.format('l_extendedprice')} as total from lineitem group by 1")
def _(t):
    root = t.scratch("s1")
    t.lineitem.write.parquet(root)
    return S.read_stage_parquet(t.spark, root).groupBy("l_returnflag").agg(n_rows("n"), money("l_extendedprice", "total"))


@query("s2_json_lines", "select event_type, count(*) as n, round(sum(value), 2) as total from events group by 1")
def _(t):
    root = t.scratch("s2")
    t.events.write.option("compression", "gzip").json(root)
    rows = S.read_stage_json(t.spark, root, "event_id bigint, event_type string, value double")
    return rows.groupBy("event_type").agg(n_rows("n"), F.round(F.sum("value"), 2).alias("total"))


@query("s2_json_outer_array", "select event_type, count(*) as n from events group by 1")
def _(t):
    """Files that are one array of up to 2,000 records each."""
    root = t.scratch("s2a")
    record = F.to_json(F.struct("event_id", "event_type"))
    arrays = t.events.groupBy(F.expr("event_id div 2000").alias("file")).agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(record), ",\n"), F.lit("]")).alias("value"))
    arrays.write.partitionBy("file").text(root)
    rows = S.read_stage_json(t.spark, root, "event_id bigint, event_type string", strip_outer_array=True)
    return rows.groupBy("event_type").agg(n_rows("n"))


@query("s3_path_columns", EVENTS_BY_DAY.replace("group by 1", "where event_type = 'click' group by 1"))
def _(t):
    root = _landed(t, "s3", "json", ("event_type", "day"))
    rows = S.read_stage_json(t.spark, root, "event_id bigint, user_id bigint")
    rows = S.with_path_columns(rows, root, {"kind": (1, "string"), "day_part": (2, "string"), "not_a_date": (2, "date")}, "filename")
    clicks = rows.filter((F.col("kind") == "event_type=click") & F.col("not_a_date").isNull() & F.col("filename").startswith("event_type"))
    return _by_day(clicks.withColumn("day", F.split_part("day_part", F.lit("="), F.lit(2))))


@query("s4_partition_keys", "select strftime(o_orderdate, '%Y-%m') as billing_period, count(*) as n from orders group by 1")
def _(t):
    root = t.scratch("s4")
    period = F.date_format("o_orderdate", "yyyy-MM")
    W.clustered(t.orders.withColumn("billing_period", period), ["billing_period"]).write.partitionBy("billing_period").parquet(root)
    return S.read_partitioned(t.spark, root).groupBy("billing_period").agg(n_rows("n"))


@query("s5_last_partitions", EVENTS_BY_DAY.replace("group by 1", "where cast(ts as date) > date '2024-01-31' - 10 group by 1"))
def _(t):
    rows = t.spark.read.parquet(_landed(t, "s5"))
    return _by_day(S.last_partitions(rows.withColumn("day", F.col("day").cast("date")), "day", day("2024-01-31"), 10))


@query("s6_load_new_files", EVENTS_BY_DAY)
def _(t):
    root, target, ledger = t.scratch("s6"), t.scratch("s6-table"), t.scratch("s6-ledger")
    schema = t.events.schema
    for older in (True, False):
        part = t.events.filter((F.col("ts") < day("2024-01-15")) == F.lit(older))
        part.write.mode("append").parquet(root)
        S.load_new_files(t.spark, root, target, ledger, schema, pattern="*.parquet")
    return _by_day(S.read_loaded(t.spark, target, schema).withColumn("day", F.to_date("ts")))


@query("s7_forced_reload", "select strftime(l_shipdate, '%Y') as year, count(*) as n, count(*) filter (year(l_shipdate) = 1997) as reloaded from lineitem group by 1")
def _(t):
    target = t.scratch("s7")
    rows = t.lineitem.select("l_orderkey", F.date_format("l_shipdate", "yyyy").alias("year"), F.lit(0).alias("load"))
    W.overwrite_partitions(rows, target, ["year"])
    W.overwrite_partitions(rows.filter("year = '1997'").withColumn("load", F.lit(1)), target, ["year"])
    return S.read_partitioned(t.spark, target).groupBy("year").agg(n_rows("n"), F.count_if(F.col("load") == 1).alias("reloaded"))


@query("s8_match_columns", "select o_orderkey, o_orderstatus, null::varchar as note from orders")
def _(t):
    from pyspark.sql.types import StructType

    landed = t.orders.select(F.col("o_orderstatus").alias("O_ORDERSTATUS"), F.col("o_orderkey").cast("int").alias("O_OrderKey"), "o_totalprice")
    return S.match_columns(landed, StructType.fromDDL("o_orderkey bigint, o_orderstatus string, note string"))


@query("s9_recursive_scan", EVENTS_BY_DAY)
def _(t):
    root = _landed(t, "s9", levels=("event_type", "day"))
    rows = S.read_stage_parquet(t.spark, root, recursive=True)
    return _by_day(rows.withColumn("day", F.to_date("ts")))


@query("s10_name_pattern", EVENTS_BY_DAY)
def _(t):
    root = t.scratch("s10")
    t.events.write.mode("append").parquet(root)
    t.events.select("event_id").write.mode("append").json(root)
    return _by_day(S.read_stage_parquet(t.spark, root, pattern="*.parquet").withColumn("day", F.to_date("ts")))


@query("s11_empty_location", "select event_id from events where event_type = 'signup'")
def _(t):
    nothing = S.read_stage_parquet(t.spark, t.scratch("s11") + "/none", schema=t.events.schema)
    return nothing.unionByName(t.events.filter("event_type = 'signup'")).select("event_id")


@query("s12_skip_bad_records", "select event_id, value from events where event_type <> 'error'")
def _(t):
    root = t.scratch("s12")
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), F.col("event_id"))).otherwise(F.to_json(F.struct("event_id", "value")))
    t.events.select(line.alias("value")).write.text(root)
    return S.read_stage_json(t.spark, root, "event_id bigint, value double", on_error="continue")


@query("s13_load_audit", """
select 1 as run, true as has_files, count(*) filter (event_type <> 'error') as rows_loaded, count(*) filter (event_type <> 'error') as total_rows from events
union all select 2, true, count(*) filter (event_type = 'error'), count(*) from events union all select 3, false, 0, count(*) from events""")
def _(t):
    """Three runs: of the first files, of files that came later, and of nothing new; the table agrees with the audit."""
    source, target, ledger = t.scratch("s13"), t.scratch("s13-table"), t.scratch("s13-ledger")
    said = []
    for run, rows in enumerate((t.events.filter("event_type <> 'error'"), t.events.filter("event_type = 'error'"), None), 1):
        if rows is not None:
            rows.write.mode("append").parquet(source)
        audit = S.load_new_files(t.spark, source, target, ledger, t.events.schema)
        said.append((run, audit["files_loaded"] > 0, audit["rows_loaded"], audit["total_rows"]))
    whole = S.load_audit(S.read_loaded(t.spark, target, t.events.schema)).select(F.col("rows_loaded").alias("_rows"))
    runs = t.spark.createDataFrame(said, "run int, has_files boolean, rows_loaded long, total_rows long")
    return runs.join(F.broadcast(whole), F.lit(True)).select("run", "has_files", "rows_loaded", F.when(F.col("run") < 3, F.col("total_rows")).otherwise(F.col("_rows")).alias("total_rows"))


@query("w5_partition_overwrite", "select o_orderstatus, count(*) as n, count(*) filter (o_orderstatus = 'P' and o_totalprice > 100000) as large from orders where o_orderstatus <> 'P' or o_totalprice > 100000 group by 1")
def _(t):
    target = t.scratch("w5")
    W.overwrite_partitions(t.orders, target, ["o_orderstatus"])
    W.overwrite_partitions(t.orders.filter("o_orderstatus = 'P' and o_totalprice > 100000"), target, ["o_orderstatus"])
    large = F.count_if((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 100000))
    return t.spark.read.parquet(target).groupBy("o_orderstatus").agg(n_rows("n"), large.alias("large"))


@query("w10_csv_export", "select o_orderkey, case when o_orderstatus = 'P' then null else o_orderpriority || ', \"x\"' end as note from orders where o_orderdate >= date '1996-01-01' and o_orderdate < date '1996-01-08'")
def _(t):
    from datetime import date

    from lakeops.functions.dates import in_window, last_full_week

    path = t.scratch("w10")
    note = F.when(F.col("o_orderstatus") != "P", F.concat("o_orderpriority", F.lit(', "x"')))
    week = t.orders.filter(in_window(F.col("o_orderdate"), last_full_week(date(1996, 1, 10))))
    W.export_csv(week.select("o_orderkey", note.alias("note")), path)
    return t.spark.read.schema("o_orderkey bigint, note string").csv(path, header=True, escape='"')


@query("w11_serving_projection", f"select l_returnflag as flag, l_linestatus as status, count(*) as lines, {MONEY_SQL.format('l_extendedprice')} as revenue from lineitem group by 1, 2")
def _(t):
    path = t.scratch("w11")
    totals = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(n_rows("n"), money("l_extendedprice", "total"))
    W.export_projection(totals, {"flag": "l_returnflag", "status": "l_linestatus", "lines": "n", "revenue": "total"}, path)
    return t.spark.read.parquet(path)


@query("w12_chunked_output", "select count(*) as objects, true as within_limit from orders")
def _(t):
    path = t.scratch("w12")
    W.write_chunks(t.orders, path, 150)
    per_file = t.spark.read.json(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(n_rows("n"))
    return per_file.agg(F.sum("n").alias("objects"), (F.max("n") <= 150).alias("within_limit"))


@query("w13_staged_rows", "select count(*) as rows_staged, true as within_limit from conversations where role <> 'system'")
def _(t):
    path = t.scratch("w13")
    rows = t.conversations.withColumn("run_id", F.when(F.col("role") != "system", F.concat_ws("-", "conv_id", "turn")))
    W.stage_rows(rows, path, "run_id")
    per_file = t.spark.read.json(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(n_rows("n"))
    return per_file.agg(F.sum("n").alias("rows_staged"), (F.max("n") <= 250).alias("within_limit"))


@query("table_publish", "select c_custkey, case when c_nationkey < 8 then 'second' else 'first' end as version from customer")
def _(t):
    from lakeops.sinks.merge import upsert

    root = t.scratch("table")
    W.publish(t.customer.withColumn("version", F.lit("first")), root)
    changed = t.customer.filter("c_nationkey < 8").withColumn("version", F.lit("second"))
    W.publish(upsert(W.read_table(t.spark, root), changed, ["c_custkey"]), root)
    return W.read_table(t.spark, root).select("c_custkey", "version")
