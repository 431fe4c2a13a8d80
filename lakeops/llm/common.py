"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts of one Arrow batch are handled in pieces of about this many bytes, so that a task's memory does not follow
#: the length of its texts.
PIECE_BYTES = 1_000_000

#: Row numbers and running sums are taken inside so many slices of a group.
SLICE_BITS = 12


def own_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that others cannot clash with what an operator adds; a missing one is an error."""
    return df.select(*[F.col(c) for c in columns])


def packed(df: DataFrame, *columns: Column | str) -> DataFrame:
    """The whole row as ``_row`` beside some columns, so that no other column of it can clash; ``select("_row.*")`` gives it back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *columns)


def held_out(doc_id: Column) -> Column:
    """Rows kept from every fit: crc32 of the id as text, modulo 5, is 0. A NULL id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def unit(*columns: Column) -> Column:
    """A repeatable number in [0, 1) for each distinct value."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / float(1 << 30)


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """UTF-8 bytes of each text, None for NULL."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts (NULL as b'') with the place of the first: as many as fit the limit, one at least."""
    start, held, size = 0, [], 0
    for i, value in enumerate(column):
        raw = value.as_py() or b""
        if held and size + len(raw) > limit:
            yield start, held
            start, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield start, held


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on hands at most 1,000 rows and about 8 MB at once to Python.

    With the default of 10,000 rows, texts of some kilobytes make batches of tens of megabytes, of which JVM and Python hold several.
    """
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "1000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "8388608")):
        if df.sparkSession.conf.get(key, None) != value:
            df.sparkSession.conf.set(key, value)
    return df


def map_texts(
    df: DataFrame, work: Callable[[list[bytes]], Mapping[str, Sequence]], adds: Sequence[tuple[str, T.DataType]], text: str = "text"
) -> DataFrame:
    """Add the columns that ``work`` makes from lists of whole texts; the text itself is not returned.

    ``work`` gets the UTF-8 bytes of some texts (NULL as b'') and returns a value for each text and column.
    """
    keeps = [f for f in df.schema.fields if f.name != text]
    out = T.StructType([*keeps, *[T.StructField(name, kind) for name, kind in adds]])
    names = [f.name for f in keeps]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        for batch in batches:
            column = texts_of(batch.column(batch.schema.get_field_index(text)))
            for start, raw in pieces(column):
                made = work(raw)
                part = batch.slice(start, len(raw))
                arrays = [part.column(part.schema.get_field_index(n)) for n in names]
                arrays = [a.cast(schema.field(n).type) for a, n in zip(arrays, names, strict=True)]
                for name, _ in adds:
                    arrays.append(pa.array(made[name], type=schema.field(name).type))
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return in_small_batches(df).mapInArrow(run, out)


def keep_texts(df: DataFrame, keep: Callable[[list[bytes]], Sequence[bool]], text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text passes ``keep``, which gets lists of whole texts (NULL as b'')."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts_of(batch.column(batch.schema.get_field_index(text)))
            yield batch.filter(pa.array([x for _, raw in pieces(column) for x in keep(raw)], pa.bool_()))

    return in_small_batches(df).mapInArrow(run, df.schema)


def hash_slice(hashed: Column) -> Column:
    """The leading bits of a hash: 4,096 slices that grow with the hash."""
    return F.shiftrightunsigned(hashed, 64 - SLICE_BITS).cast("int")


def numbered(df: DataFrame, keys: Sequence[str], slice_by: str, order: Sequence[str], sums: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``_rank`` (from 0) and sums over the rows before, per key, in the order of ``slice_by`` and then of ``order``.

    A key's rows are numbered inside slices, so one with a third of all rows is spread over as many tasks as it has slices; only a
    row per key and slice meets in the window over a key. Keys and slices must not be NULL. The input is read twice.
    ``sums``: {new column: summed column}. Rows that tie in everything are alike, their order does not matter.
    """
    sums = dict(sums or {})
    inside = Window.partitionBy(*keys, slice_by).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = df.withColumn("_in", F.row_number().over(inside) - 1)
    for new, column in sums.items():
        ranked = ranked.withColumn(f"_in_{new}", F.sum(column).over(upto) - F.col(column))
    totals = df.groupBy(*keys, slice_by).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_n_{new}") for new, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy(slice_by).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *keys, slice_by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        *[F.coalesce(F.sum(f"_n_{new}").over(before), F.lit(0)).alias(f"_before_{new}") for new in sums],
    )
    return ranked.join(totals, [*keys, slice_by]).select(
        *df.columns, (F.col("_before") + F.col("_in")).alias("_rank"),
        *[(F.col(f"_before_{new}") + F.col(f"_in_{new}")).alias(new) for new in sums],
    )


def hash_buckets(ids: DataFrame, column: str, bits: int = 20) -> DataFrame:
    """The hash buckets that some ids fall in: a table of at most 2^20 integers, whatever the number of ids."""
    return ids.select(F.pmod(F.xxhash64(column), F.lit(1 << bits)).cast("int").alias("_bucket")).distinct()


def in_buckets(df: DataFrame, column: str, buckets: DataFrame, how: str = "left_semi", bits: int = 20) -> DataFrame:
    """Rows whose id may be (``left_semi``) or is surely not (``left_anti``) among the ids of ``buckets``.

    It spares the shuffle of whole texts before an exact join with few ids; with many ids it lets all rows pass.
    The broadcast side has at most 2^20 rows of an integer.
    """
    rows = df.withColumn("_hashed", F.pmod(F.xxhash64(column), F.lit(1 << bits)).cast("int"))
    return rows.join(F.broadcast(buckets), F.col("_hashed") == F.col("_bucket"), how).drop("_hashed")
