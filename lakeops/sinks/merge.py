"""Write modes as DataFrame functions: what a target holds after a batch.

Results are new DataFrames; ``lakeops.sinks.tables`` writes them next to the old data, never over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source of a merge; a key that it has twice fails the job, as it would a MERGE. NULL keys match nothing and may repeat.

    Keys are counted apart from the rows, which combines before the shuffle; the rows themselves are not moved.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    twice = source.filter(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    error = F.raise_error(F.lit(f"a key of {', '.join(keys)} is twice in the source of a merge"))
    none = twice.filter(error.cast("boolean")).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema.fields])
    return source.unionByName(none)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched keys take the source row, other source rows are added; a key that the source has twice is an error."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(unique_source(source, keys))


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus source rows with new keys; rows already there are not touched; a key that the source has twice is an error."""
    source = unique_source(source, keys)
    return target.unionByName(source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns))


def update_payload(target: DataFrame, source: DataFrame, keys: Sequence[str], payload: str, empty: str = "{}") -> DataFrame:
    """Update one column of matched rows, unless the inbound value is empty; add unmatched rows whole. A key that the source has twice is an error."""
    source = unique_source(source, keys)
    rest = [c for c in target.columns if c not in keys]
    t = target.select(*keys, F.struct(*rest).alias("_t"))
    s = source.select(*keys, F.struct(*rest).alias("_s"))
    inbound = F.nullif(F.col(f"_s.{payload}"), F.lit(empty))
    old = F.col("_t").isNotNull()
    merged = [
        F.when(old & F.col("_s").isNotNull(), F.coalesce(inbound, F.col(f"_t.{c}")) if c == payload else F.col(f"_t.{c}"))
        .when(old, F.col(f"_t.{c}"))
        .otherwise(F.col(f"_s.{c}"))
        .alias(c)
        for c in rest
    ]
    return t.join(s, list(keys), "full_outer").select(*keys, *merged).select(*target.columns)


def append_evolving(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append; columns on one side only are NULL on the other."""
    return target.unionByName(source, allowMissingColumns=True)


def replace_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace the windows (key tuples) that occur in the batch."""
    present = batch.select(*keys).distinct()
    return target.join(present, list(keys), "left_anti").select(*target.columns).unionByName(batch)


def replace_range(target: DataFrame | None, batch: DataFrame, column: str, start: Column, end: Column, inclusive: bool = False) -> DataFrame:
    """Replace a date range, half-open or with both ends; without a target the batch is the table."""
    if target is None:
        return batch
    inside = (F.col(column) >= start) & ((F.col(column) <= end) if inclusive else (F.col(column) < end))
    return target.filter(~F.coalesce(inside, F.lit(False))).unionByName(batch)


def replace_value(target: DataFrame, batch: DataFrame, column: str, value: Column) -> DataFrame:
    """Replace one partition value."""
    return target.filter(~F.col(column).eqNullSafe(value)).unionByName(batch)


def replace_all(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Full replace; an empty batch empties the target."""
    return batch.select(*target.columns)


def replace_if_any(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Full replace that keeps the target when the batch is empty."""
    return target if batch.isEmpty() else batch.select(*target.columns)


def append_run(target: DataFrame | None, batch: DataFrame, run_at: Column, stamp: str = "predicted_at") -> DataFrame:
    """Append a run's rows with its timestamp."""
    stamped = batch.withColumn(stamp, run_at)
    return stamped if target is None else target.unionByName(stamped, allowMissingColumns=True)
