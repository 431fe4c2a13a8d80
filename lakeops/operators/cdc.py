"""Change logs folded to current state.

A log row has the payload, an operation (I, U or D) and a timestamp. The newest row of a key wins; a
key whose newest row is a delete is absent. Rows with the same newest timestamp are ordered by a tie
column, and a delete among them yields to the others. A NULL key is a key. Timestamps kept as text are compared as
``ts_type``, e.g. ``timestamp``: as text, times of other precision or zone would sort wrongly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.ordered import first_per_key, same_keys
from lakeops.session import materialize
from lakeops.sinks.buckets import KeyBuckets

DEFAULT_KEYS = ["id"]


def key_columns(table: str, overrides: Mapping[str, Sequence[str]] | None = None) -> list[str]:
    """Key of a replicated table: ``id`` unless the table has its own."""
    return list((overrides or {}).get(table, DEFAULT_KEYS))


def _time(ts: str, ts_type: str | None) -> Column:
    return F.col(ts).cast(ts_type) if ts_type else F.col(ts)


def _newest_first(ts: str, op: str, tie: Sequence[str], ts_type: str | None) -> list[Column]:
    return [_time(ts, ts_type).desc(), (F.col(op) == "D").asc(), *[F.col(t).desc() for t in tie]]


def cdc_latest(log: DataFrame, keys: Sequence[str], ts: str, op: str, tie: Sequence[str] = (), ts_type: str | None = None) -> DataFrame:
    """Newest row of each key, deletes included."""
    return first_per_key(log, keys, _newest_first(ts, op, tie, ts_type))


def cdc_current(
    log: DataFrame, keys: Sequence[str], ts: str, op: str, tie: Sequence[str] = (), baseline: DataFrame | None = None, ts_type: str | None = None
) -> DataFrame:
    """Current state of a change log, without the operation and timestamp.

    ``baseline`` is an optional full load; its rows count as inserts older than any log row.
    """
    if baseline is not None:
        old = baseline.withColumn(op, F.lit("I")).withColumn(ts, F.lit(None).cast(log.schema[ts].dataType))
        log = log.unionByName(old, allowMissingColumns=True)
    return cdc_latest(log, keys, ts, op, tie, ts_type).filter(F.col(op) != "D").drop(ts, op)


def cdc_current_two_phase(
    log: DataFrame, keys: Sequence[str], ts: str, op: str, tie: Sequence[str] = (), ts_type: str | None = None
) -> DataFrame:
    """The same state for wide rows.

    The first pass reads key and timestamp only and combines before its shuffle; the wide rows are then
    joined on key and timestamp, which spreads a hot key over its timestamps. Only rows that tie at the
    newest timestamp remain to be folded. A NULL key is a key, and a NULL time is older than any other, as in one pass.
    """
    newest = log.groupBy(*keys).agg(F.max(_time(ts, ts_type)).alias("_newest")).select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_newest")
    tied = log.join(newest, _time(ts, ts_type).eqNullSafe(F.col("_newest")) & same_keys(keys, "_key_"), "left_semi")
    return first_per_key(tied, keys, _newest_first(ts, op, tie, ts_type)).filter(F.col(op) != "D").drop(ts, op)


def cdc_apply(
    state: DataFrame, batch: DataFrame, keys: Sequence[str], ts: str, op: str, tie: Sequence[str] = (), ts_type: str | None = None
) -> DataFrame:
    """Fold a batch of log rows into a state of newest rows (tombstones kept).

    The batch is folded first; then one full outer join on the key keeps the newer of two rows, and keys
    the batch does not touch pass through. Applying a batch twice changes nothing, and a late older row
    does not undo a delete because the tombstone holds its timestamp.
    """
    columns = state.columns
    rank = F.struct(_time(ts, ts_type), F.col(op) != "D", *tie)
    old = state.select(*[F.col(k).alias(f"_key_{k}") for k in keys], rank.alias("_old_rank"), F.struct(*columns).alias("_old"))
    new = cdc_latest(batch, keys, ts, op, tie, ts_type).select(*keys, rank.alias("_new_rank"), F.struct(*columns).alias("_new"))
    both = old.join(new, same_keys(keys, "_key_"), "full_outer")
    keep = F.col("_new").isNull() | (F.col("_old").isNotNull() & (F.col("_old_rank") >= F.col("_new_rank")))
    return both.select(F.when(keep, F.col("_old")).otherwise(F.col("_new")).alias("r")).select("r.*")


def cdc_merge(table: KeyBuckets, batch: DataFrame, version: int, ts: str, op: str, tie: Sequence[str] = (), ts_type: str | None = None) -> None:
    """``cdc_apply`` on a stored state of newest rows: reads and rewrites only the key buckets of the batch.

    ``version`` grows from batch to batch; the same version again replaces what it did before.
    """
    columns = table.schema.names
    newest = materialize(cdc_latest(batch.select(*columns), table.keys, ts, op, tie, ts_type), "cdc_batch")
    touched = table.touched(newest)
    table.write(cdc_apply(table.read(touched, before=version), newest, table.keys, ts, op, tie, ts_type), touched, version)


def visible(state: DataFrame, ts: str, op: str) -> DataFrame:
    """Rows of a state that are not tombstones."""
    return state.filter(F.col(op) != "D").drop(ts, op)
