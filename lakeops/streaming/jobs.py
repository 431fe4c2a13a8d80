"""Structured Streaming jobs. All take a trigger-available-now run, so they suit a schedule."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators.cdc import cdc_latest, cdc_merge, visible
from lakeops.sinks.buckets import KeyBuckets, folders, remove
from lakeops.sinks.tables import write_counted
from lakeops.sources.files import list_files

# Upper bounds in hours and labels of landing-lag buckets.
LAG_BUCKETS = [(6, "<6h"), (12, "6-12h"), (24, "12-24h"), (48, "24-48h"), (168, "2-7d")]
LAG_REST = ">7d"


def run_available(writer) -> None:
    """Start a stream writer and process what is there."""
    writer.trigger(availableNow=True).start().awaitTermination()


def append_to_table(rows: DataFrame, target: str, checkpoint: str) -> None:
    """Stream to a parquet table; each input file once, also after a restart."""
    run_available(rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint))


def append_with_metrics(rows: DataFrame, target: str, metrics: str, checkpoint: str) -> None:
    """Stream to a table with a folder for each batch, and a row of metrics for each batch to another.

    A replayed batch overwrites both, so all batches of all runs are counted once. The rows are observed while they are written.
    """

    def write(batch: DataFrame, number: int) -> None:
        began = time.monotonic()
        rows = write_counted(batch, f"{target}/batch={number}")
        took = int((time.monotonic() - began) * 1000)
        row = [(rows, "INCREMENTAL" if rows else "NO_DATA", took)]
        batch.sparkSession.createDataFrame(row, "rows long, action string, duration_ms long").coalesce(1).write.mode("overwrite").parquet(f"{metrics}/batch={number}")

    run_available(rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))


def refresh_metrics(spark: SparkSession, metrics: str) -> DataFrame:
    """(rows, action, duration_ms, batch) of every batch written so far."""
    schema = "rows long, action string, duration_ms long, batch long"
    return spark.read.schema(schema).parquet(metrics) if list_files(spark, metrics, 1) else spark.createDataFrame([], schema)


@dataclass(frozen=True)
class FoldedLog:
    """Where a change-log stream keeps its state, and how it is folded: folds of batches in ``pending``, newest rows in key buckets."""

    root: str
    schema: StructType
    keys: Sequence[str]
    ts: str
    op: str
    tie: Sequence[str] = ()
    buckets: int = 64
    compact_every: int = 8

    def table(self, spark: SparkSession) -> KeyBuckets:
        return KeyBuckets(spark, f"{self.root}/buckets", self.schema, self.keys, self.buckets)

    def pending(self, spark: SparkSession) -> dict[int, str]:
        return folders(spark, f"{self.root}/pending", "batch=")


def fold_change_log(log: DataFrame, state: FoldedLog, checkpoint: str) -> None:
    """Change-log stream to a folded state.

    Each micro-batch is folded to its newest row per key and written, deletes included, to the folder
    of its own batch number: the work is that of the batch, and a replayed batch overwrites itself. Every ``compact_every`` batches the
    waiting folders are merged into the key buckets they touch, so readers meet few of them. Folding a row twice changes nothing, so a
    broken-off merge does no harm.
    """

    def write(batch: DataFrame, number: int) -> None:
        cdc_latest(batch, state.keys, state.ts, state.op, state.tie).write.mode("overwrite").parquet(f"{state.root}/pending/batch={number}")
        if (number + 1) % state.compact_every == 0:
            compact_state(batch.sparkSession, state, number)

    run_available(log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))


def compact_state(spark: SparkSession, state: FoldedLog, version: int) -> None:
    """Merge the waiting batches into the key buckets that they touch, and remove them. A version that is committed already is only tidied."""
    waiting = state.pending(spark)
    table = state.table(spark)
    if waiting and version not in table.committed():
        cdc_merge(table, spark.read.schema(state.schema).parquet(*waiting.values()), version, state.ts, state.op, state.tie)
    for path in waiting.values():
        remove(spark, path)


def folded_state(spark: SparkSession, state: FoldedLog) -> DataFrame:
    """Newest row per key over the buckets and the waiting batches, tombstones included."""
    waiting = state.pending(spark)
    rows = state.table(spark).read()
    if not waiting:
        return rows
    return cdc_latest(rows.unionByName(spark.read.schema(state.schema).parquet(*waiting.values())), state.keys, state.ts, state.op, state.tie)


def current_state(spark: SparkSession, state: FoldedLog) -> DataFrame:
    return visible(folded_state(spark, state), state.ts, state.op)


def stream_sessions(
    views: DataFrame, visitor: str, ts: str, gap: str = "30 minutes", lateness: str = "48 hours", measures: Sequence[Column] = (), salt: Column | None = None,
) -> DataFrame:
    """Sessions of a stream of views: start, end, number of views.

    Merging session windows needs only their bounds and sums as state, not the views. With a ``salt`` the views of a visitor are dealt to so many state
    keys, and the sessions, which then have a column ``salt``, are parts for ``merge_sessions``: views without a visitor, or of a
    very busy one, are not one key of the state.
    """
    # Gaps count whole seconds, and a row exactly one gap later still belongs to the session, both as in
    # the batch operator.
    at = views.withColumn("_at", F.date_trunc("second", ts)).withWatermark("_at", lateness)
    salted = [] if salt is None else [salt.alias("salt")]
    windowed = at.groupBy(visitor, *salted, F.session_window("_at", gap).alias("w"))
    counted = windowed.agg(F.min(ts).alias("session_start_at"), F.max(ts).alias("session_end_at"), F.count(F.lit(1)).alias("views"), *measures)
    return counted.drop("w")


def open_sessions(
    views: DataFrame, visitor: str, ts: str, mark: Column, gap: str = "30 minutes", measures: Sequence[Column] = (), salt: Column | None = None,
    closed: DataFrame | None = None,
) -> DataFrame:
    """The sessions that a stream with its watermark at ``mark`` still holds, from the table of its views.

    Only keys with a view since the mark, less the gap, can have one; a session may reach back. With the ``closed`` sessions of the stream only the views after
    a key's last closed session are read.
    """
    keyed = views.withColumn("salt", F.lit(0) if salt is None else salt)
    late = keyed.filter(F.date_trunc("second", ts) + F.expr(f"interval {gap}") > mark).select(F.col(visitor).alias("_visitor"), F.col("salt").alias("_salt")).distinct()
    same = F.col(visitor).eqNullSafe(F.col("_visitor")) & (F.col("salt") == F.col("_salt"))
    theirs = keyed.join(late, same, "left_semi")
    if closed is not None:
        ends = closed.groupBy(F.col(visitor).alias("_visitor"), (F.lit(0) if salt is None else F.col("salt")).alias("_salt")).agg(F.max("session_end_at").alias("_end"))
        theirs = theirs.join(ends, same, "left").filter(F.col("_end").isNull() | (F.col(ts) > F.col("_end"))).drop("_visitor", "_salt", "_end")
    sessions = stream_sessions(theirs, visitor, ts, gap, measures=measures, salt=F.col("salt"))
    sessions = sessions.filter(F.date_trunc("second", "session_end_at") + F.expr(f"interval {gap}") > mark)
    return sessions.drop("salt") if salt is None else sessions


def without_duplicates(rows: DataFrame, key: Sequence[str], ts: str, lateness: str = "48 hours") -> DataFrame:
    """One row per key among rows that arrive within the lateness; state is dropped after it."""
    return rows.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(key))


def lag_bucket(created: Column, landed: Column) -> Column:
    hours = (F.unix_micros(landed.cast("timestamp")) - F.unix_micros(created.cast("timestamp"))) / 3_600_000_000
    out = None
    for bound, label in LAG_BUCKETS:
        out = F.when(hours < bound, label) if out is None else out.when(hours < bound, label)
    return out.otherwise(LAG_REST)


def landing_lag(rows: DataFrame, created: str, landed: str) -> DataFrame:
    """Rows per landing-lag bucket; works on tables and, in complete mode, on streams."""
    bucket = lag_bucket(F.col(created), F.col(landed)).alias("lag_bucket")
    return rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("row_count"))


def windowed_usage(rows: DataFrame, ts: str, width: str, keys: Sequence[str] = (), measures: Sequence[Column] = (), lateness: str | None = None) -> DataFrame:
    """Counts per tumbling window; with a lateness the windows of a stream close."""
    if lateness:
        rows = rows.withWatermark(ts, lateness)
    counted = rows.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), *measures)
    return counted.select(F.col("w.start").alias("starting_at"), F.col("w.end").alias("ending_at"), *[c for c in counted.columns if c != "w"])
