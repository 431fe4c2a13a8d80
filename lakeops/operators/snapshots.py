"""Row history with validity intervals (slowly changing dimension, type 2).

A history has the source columns and ``valid_from``, ``valid_to`` and ``is_current``; a key has at most
one current version; NULL is a key like any other. A batch has one row per key. Re-running a batch changes nothing.

``snapshot_by_timestamp`` and ``snapshot_by_check`` take and return a whole history. ``SplitHistory`` is the stored form: current versions lie in
key buckets, closed ones are appended and not read by a run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.ordered import same_keys
from lakeops.session import materialize
from lakeops.sinks.buckets import KeyBuckets, folders, remove

BOOKKEEPING = ["valid_from", "valid_to", "is_current"]

# Fixed value: stands for NULL inside a surrogate key.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def expression_key(*columns: Column) -> Column:
    """Key text of several columns, NULL if any is NULL."""
    parts: list[Column] = []
    for c in columns:
        parts += [F.lit("-"), c.cast("string")]
    return F.concat(*parts[1:])


def surrogate_key(*columns: Column) -> Column:
    """Hash of several columns, with a marker for NULL."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(NULL_MARKER)) for c in columns]))


def start_history(batch: DataFrame, valid_from: Column) -> DataFrame:
    stamp = valid_from.alias("valid_from")
    return batch.select("*", stamp).select(
        "*", F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current")
    )


def _matched(
    current: DataFrame, batch: DataFrame, keys: Sequence[str], changed: Column, valid_from: Column, closed_at: Column | None,
) -> DataFrame:
    """Current versions met with the batch: the keys, ``old``, ``new``, whether a version ``_opens`` or ``_closes``, ``_from`` and ``_end``.

    Current versions whose key the batch does not have come along only with ``closed_at``, which closes them.
    """
    payload = [c for c in current.columns if c not in BOOKKEEPING]
    old = current.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.struct(*current.columns).alias("old"))
    new = batch.select(*keys, F.struct(*payload).alias("new"), valid_from.alias("_from"))
    both = new.join(old, same_keys(keys, "_key_"), "left" if closed_at is None else "full_outer")
    was, is_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    closes = was & is_new & changed
    end = F.when(closes, F.col("_from"))
    if closed_at is not None:
        closes = closes | (was & ~is_new)
        end = F.coalesce(end, closed_at)
    return both.select(
        *[F.coalesce(F.col(k), F.col(f"_key_{k}")).alias(k) for k in keys], "old", "new", "_from", end.alias("_end"),
        (is_new & (~was | changed)).alias("_opens"), closes.alias("_closes"),
    )


def _closing(columns: Sequence[str], closes: Column | None = None) -> Column:
    """The old version of a matched row, closed where it closes."""
    closes = F.lit(True) if closes is None else closes
    own = {"valid_to": F.when(closes, F.col("_end")).otherwise(F.col("old.valid_to")), "is_current": ~closes}
    return F.struct(*[own.get(c, F.col(f"old.{c}")).alias(c) for c in columns])


def _opening(columns: Sequence[str]) -> Column:
    own = {"valid_from": F.col("_from"), "valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)}
    return F.struct(*[own[c].alias(c) if c in own else F.col(f"new.{c}").alias(c) for c in columns])


def _merge(
    history: DataFrame, batch: DataFrame, keys: Sequence[str], changed: Column, valid_from: Column,
    closed_at: Column | None,
) -> DataFrame:
    """Close and open versions in one join of current rows and batch."""
    columns = history.columns
    current = history.filter("is_current")
    met = _matched(current, batch, keys, changed, valid_from, closed_at)
    old = F.col("old").isNotNull()
    versions = F.filter(F.array(F.when(old, _closing(columns, F.col("_closes"))), F.when(F.col("_opens"), _opening(columns))), lambda v: v.isNotNull())
    merged = met.select(F.explode(versions).alias("v")).select("v.*")
    out = history.filter(~F.col("is_current")).unionByName(merged)
    if closed_at is None:  # keys that the batch does not have stay
        there = batch.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
        out = out.unionByName(current.join(there, same_keys(keys, "_key_"), "left_anti"))
    return out


def grew(updated_at: str) -> Column:
    """Whether a matched key has a later ``updated_at`` than before."""
    return F.coalesce(F.col(f"new.{updated_at}") > F.col(f"old.{updated_at}"), F.lit(False))


def differs(check_cols: Sequence[str]) -> Column:
    """Whether a matched key differs in any of the columns, NULL counting as a value."""
    changed = F.lit(False)
    for c in check_cols:
        changed = changed | ~F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}"))
    return changed


def snapshot_by_timestamp(
    history: DataFrame, batch: DataFrame, keys: Sequence[str], updated_at: str, closed_at: Column | None = None
) -> DataFrame:
    """New version when a key's ``updated_at`` grew. With ``closed_at``, keys gone from the batch are closed."""
    return _merge(history, batch, keys, grew(updated_at), F.col(updated_at).cast("timestamp_ntz"), closed_at)


def snapshot_by_check(
    history: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    taken_at: Column,
    hard_deletes: bool = False,
) -> DataFrame:
    """New version when any checked column differs, NULL counting as a value."""
    stamp = taken_at.cast("timestamp_ntz")
    return _merge(history, batch, keys, differs(check_cols), stamp, stamp if hard_deletes else None)


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """Versions valid at an instant."""
    return history.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))


@dataclass(frozen=True)
class SplitHistory:
    """A stored history: current versions in the key buckets of ``table``, closed ones below ``closed``, a folder for each run that closed some.

    A run reads the buckets its keys fall in, or all of them if it closes missing keys, and rewrites those in which a version opens or
    closes. Closed versions of a run that did not commit are not read and removed by the next.
    """

    table: KeyBuckets
    closed: str

    def read(self) -> DataFrame:
        """All versions."""
        last = max(self.table.committed(), default=-1)
        paths = [p for v, p in folders(self.table.spark, self.closed, "v=").items() if v <= last]
        current = self.table.read()
        return current.unionByName(self.table.spark.read.schema(self.table.schema).parquet(*paths)) if paths else current

    def run(self, batch: DataFrame, version: int, changed: Column, valid_from: Column, closed_at: Column | None = None) -> None:
        """Fold a batch; ``changed`` is ``grew`` or ``differs``. Versions of runs grow; one that is repeated replaces what it did."""
        table, columns = self.table, self.table.schema.names
        spark = table.spark
        last = max(table.committed(), default=-1)
        for v, path in folders(spark, self.closed, "v=").items():
            if v > last or v == version:
                remove(spark, path)
        payload = [c for c in columns if c not in BOOKKEEPING]
        fresh = batch.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in payload], valid_from.cast("timestamp_ntz").alias("_from"))
        fresh = materialize(fresh, "snapshot_batch")
        current = table.read(table.touched(fresh) if closed_at is None else None, before=version)
        met = _matched(current, fresh, table.keys, changed, F.col("_from"), None if closed_at is None else closed_at.cast("timestamp_ntz"))
        moves = materialize(met.filter("_opens or _closes"), "snapshot_moves")
        touched = table.touched(moves)
        if not touched:
            return
        gone = moves.filter("_closes")
        if not gone.isEmpty():
            gone.select(_closing(columns).alias("v")).select("v.*").write.parquet(f"{self.closed}/v={version}")
        keys = gone.select(*[F.col(k).alias(f"_key_{k}") for k in table.keys])
        stay = table.read(touched, before=version).join(keys, same_keys(table.keys, "_key_"), "left_anti")
        table.write(stay.unionByName(moves.filter("_opens").select(_opening(columns).alias("v")).select("v.*")), touched, version)
