"""Ordered computations over keys of any size.

A plain window puts all rows of a key in one task, with one exchange of the rows. That is how keys of up to some million rows are
computed. Larger keys are cut into slices along the order: rows are numbered and summed inside their slice, one small row per slice carries the totals of the
slices before and after it, and the two meet in a join on (key, slice). A key with a third of all rows
is then spread over as many tasks as it has slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of a key that one task sorts.
HOT_ROWS = 5_000_000


def non_null_keys(keys: Sequence[str], prefix: str = "_") -> list[Column]:
    """Pairs (text or '', is null) that equal-join NULL keys to each other.

    Plain columns, unlike a null-safe comparison, let one shuffle serve both a window and a join.
    """
    out = []
    for i, key in enumerate(keys):
        out.append(F.coalesce(F.col(key).cast("string"), F.lit("")).alias(f"{prefix}k{i}"))
        out.append(F.col(key).isNull().alias(f"{prefix}n{i}"))
    return out


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Join condition: each key equals the column of its name behind ``prefix``, NULL equals NULL."""
    out = F.lit(True)
    for key in keys:
        out = out & F.col(key).eqNullSafe(F.col(f"{prefix}{key}"))
    return out


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    *,
    row_number: str | None = None,
    total: str | None = None,
    lag: Mapping[str, str] | None = None,
    first: Mapping[str, str] | None = None,
    running: Mapping[str, str] | None = None,
    before: Mapping[str, str] | None = None,
    after: Mapping[str, str] | None = None,
    sums: Mapping[str, str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ordered columns per key.

    ``slice_by`` must grow with ``order`` (a day or hour of a time order, the leading part of a number);
    ``order`` must be unique within a key, NULLs come last. Mappings are {new column: source column}. ``running`` is the
    sum up to and with the row, ``before`` and ``after`` the sums of the rows on one side (0 for none).

    Keys with more than ``hot_rows`` rows are computed slice by slice, all others by a window, with the same results; None slices all.
    Rows are counted per key first, from the key columns alone and combined before the shuffle. The list of hot keys is broadcast: it has at most
    (rows / hot_rows) entries. Without any the sliced part falls away at run time.
    """
    asked = dict(
        row_number=row_number, total=total, lag=dict(lag or {}), first=dict(first or {}), running=dict(running or {}), before=dict(before or {}),
        after=dict(after or {}), sums=dict(sums or {}),
    )
    rows = df.select("*", *non_null_keys(keys))
    join_cols = [c for i in range(len(keys)) for c in (f"_k{i}", f"_n{i}")]
    if hot_rows is None:
        return _sliced(df.columns, rows, join_cols, order, slice_by, **asked)
    counted = df.select(*non_null_keys(keys)).groupBy(*join_cols).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(counted.filter(F.col("_rows") > hot_rows).drop("_rows"))
    cold = _windowed(df.columns, rows.join(hot, join_cols, "left_anti"), keys, order, **asked)  # by the keys as they are, which a later join can use
    return cold.union(_sliced(df.columns, rows.join(hot, join_cols, "left_semi"), join_cols, order, slice_by, **asked))


def _windowed(carried, rows, keys, order, *, row_number, total, lag, first, running, before, after, sums) -> DataFrame:
    whole = Window.partitionBy(*keys)
    along = whole.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    all_of = lambda c: F.coalesce(F.sum(c).over(whole), F.lit(0))
    upto_of = lambda c: F.coalesce(F.sum(c).over(upto), F.lit(0))
    out: list[Column] = [F.col(c) for c in carried]
    if row_number:
        out.append(F.row_number().over(along).cast("bigint").alias(row_number))
    if total:
        out.append(F.count(F.lit(1)).over(whole).alias(total))
    out += [F.lag(c).over(along).alias(n) for n, c in lag.items()]
    out += [F.first(c).over(upto).alias(n) for n, c in first.items()]
    out += [upto_of(c).alias(n) for n, c in running.items()]
    out += [(upto_of(c) - F.coalesce(F.col(c), F.lit(0))).alias(n) for n, c in before.items()]
    out += [(all_of(c) - upto_of(c)).alias(n) for n, c in after.items()]
    out += [all_of(c).alias(n) for n, c in sums.items()]
    return rows.select(*out)


def _sliced(carried, rows, join_cols, order, slice_by, *, row_number, total, lag, first, running, before, after, sums) -> DataFrame:
    summed = sorted(set(running.values()) | set(before.values()) | set(after.values()) | set(sums.values()))
    rows = rows.select("*", slice_by.alias("_slice")).select("*", *non_null_keys(["_slice"], "_s"))
    part_cols = [*join_cols, "_sk0", "_sn0"]
    stamp = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])

    # One row per (key, slice). Sums and min/max combine before the shuffle.
    aggs = [F.count(F.lit(1)).alias("_cnt"), F.max("_slice").alias("_slice")]
    aggs += [F.coalesce(F.sum(c), F.lit(0)).alias(f"_sum_{c}") for c in summed]
    aggs += [F.max_by(F.struct(c), stamp).alias(f"_last_{c}") for c in sorted(set(lag.values()))]
    aggs += [F.min_by(F.struct(c), stamp).alias(f"_first_{c}") for c in sorted(set(first.values()))]
    slices = rows.groupBy(*part_cols).agg(*aggs)

    by_key = Window.partitionBy(*join_cols)
    in_order = by_key.orderBy(F.col("_slice").asc_nulls_last())
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    carry = [
        F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)).alias("_cnt_before"),
        F.sum("_cnt").over(by_key).alias("_cnt_all"),
    ]
    for c in summed:
        carry.append(F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}"))
        carry.append(F.sum(f"_sum_{c}").over(by_key).alias(f"_all_{c}"))
    for c in sorted(set(lag.values())):
        carry.append(F.lag(f"_last_{c}").over(in_order).alias(f"_prev_{c}"))
    for c in sorted(set(first.values())):
        carry.append(F.first(f"_first_{c}").over(in_order).alias(f"_head_{c}"))
    slices = slices.select(*part_cols, *carry)

    in_slice = Window.partitionBy(*part_cols).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    upto = in_slice.rowsBetween(Window.unboundedPreceding, 0)
    local = [F.row_number().over(in_slice).alias("_rn")]
    local += [F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"_upto_{c}") for c in summed]
    local += [F.lag(F.struct(c)).over(in_slice).alias(f"_lag_{c}") for c in sorted(set(lag.values()))]
    rows = rows.select("*", *local).join(slices, part_cols)

    out: list[Column] = [F.col(c) for c in carried]
    if row_number:
        out.append((F.col("_cnt_before") + F.col("_rn")).alias(row_number))
    if total:
        out.append(F.col("_cnt_all").alias(total))
    upto_all = lambda c: F.col(f"_before_{c}") + F.col(f"_upto_{c}")
    own = lambda c: F.coalesce(F.col(c), F.lit(0))
    out += [F.coalesce(f"_lag_{c}", f"_prev_{c}").getField(c).alias(n) for n, c in lag.items()]
    out += [F.col(f"_head_{c}").getField(c).alias(n) for n, c in first.items()]
    out += [upto_all(c).alias(n) for n, c in running.items()]
    out += [(upto_all(c) - own(c)).alias(n) for n, c in before.items()]
    out += [(F.col(f"_all_{c}") - upto_all(c)).alias(n) for n, c in after.items()]
    out += [F.col(f"_all_{c}").alias(n) for n, c in sums.items()]
    return rows.select(*out)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First n rows of each key in the given order.

    The rank filter lets Spark cut each map task down to n rows per key before the shuffle, so a hot
    key does not concentrate.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
