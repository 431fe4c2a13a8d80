"""Incremental reads of a source table: watermarks, caps, shards, cut-overs, lookback."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.sinks.merge import upsert


def watermark(target: DataFrame, key: str):
    """Largest key of the target, or None; one value comes to the driver so that it can be pushed down."""
    return target.agg(F.max(key)).first()[0]


def next_rows(
    source: DataFrame, key: str, after=None, limit: int | None = None, where: Column | None = None, slice_by: Column | None = None
) -> DataFrame:
    """Rows past a watermark in key order, about ``limit`` per run.

    The cap is the feature: the next run goes on from the new watermark. Rows that tie with the last one within the
    cap come along, as the next watermark would skip them. Only the last key comes to the driver. ``slice_by`` grows with the
    key (a day, or a number of leading digits); rows are then first counted per slice, and only the slice in which the
    cap is reached is ordered.
    """
    rows = source if where is None else source.filter(where)
    if after is not None:
        rows = rows.filter(F.col(key) > F.lit(after))
    if limit is None:
        return rows
    within, missing = rows, limit
    if slice_by is not None:
        counted = rows.groupBy(slice_by.alias("s")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy(F.lit(1)).orderBy("s").rowsBetween(Window.unboundedPreceding, 0))
        reached = counted.withColumn("before", upto - F.col("n")).filter(F.col("before") + F.col("n") >= limit).agg(F.min(F.struct("s", "before")).alias("r")).first()["r"]
        if reached is None:
            return rows
        within, missing = rows.filter(slice_by == F.lit(reached["s"])), limit - reached["before"]
    last = within.select(key).orderBy(key).limit(missing).agg(F.max(key), F.count(key)).first()
    return rows if last[1] < missing else rows.filter(F.col(key) <= F.lit(last[0]))


def incremental_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], updated_at: str, after=None, limit: int | None = None, slice_by: Column | None = None
) -> DataFrame:
    """Rows updated past the watermark, upserted on the key."""
    return upsert(target, next_rows(source, updated_at, after, limit, slice_by=slice_by), keys)


def typed_json(df: DataFrame, column: str) -> DataFrame:
    """Text column as a JSON value; malformed text is NULL."""
    return df.withColumn(column, F.try_parse_json(column))


def union_shards(shards: Mapping[int | str, DataFrame], tag: str = "shard_id") -> DataFrame:
    """Same-shaped shards with their tag; keys may repeat between shards."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in shards.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def cut_over(before: DataFrame, after: DataFrame, ts: str, at: Column) -> DataFrame:
    """Rows before an instant from one source, from it on from another."""
    old, new = before.filter(F.col(ts) < at), after.filter(F.col(ts) >= at)
    return old.unionByName(new, allowMissingColumns=True)


def reread_lookback(
    target: DataFrame, source: DataFrame, keys: Sequence[str], ts: str, mark: Column, hours: int = 48, days: int = 7
) -> DataFrame:
    """Re-read the last hours of the source and upsert them into the recent part of the target.

    Target rows older than ``days`` before the mark cannot match and are not joined; both bounds are
    literals, so a date-partitioned target is only read where it can change.
    """
    if hours > days * 24:
        raise ValueError("the lookback must stay inside the target window")
    fresh = source.filter(F.col(ts) >= mark - F.expr(f"interval {hours} hours"))
    floor = mark - F.expr(f"interval {days} days")
    recent = target.filter(F.col(ts) >= floor)
    return target.filter(F.col(ts) < floor).unionByName(upsert(recent, fresh, keys))


def rolling_counts(source: DataFrame, ts: str, key: str, today: Column, days: int = 7, where: Column | None = None, name: str = "user_events_count") -> DataFrame:
    """Rows per day and key over the last days, today included."""
    rows = source if where is None else source.filter(where)
    day = F.col(ts).cast("date")
    recent = rows.filter((day >= F.date_sub(today, days)) & (day <= today))
    return recent.groupBy(day.alias("date"), key).agg(F.count(F.lit(1)).alias(name))
