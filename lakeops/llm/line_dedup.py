"""Lines that an earlier document holds already, as a keep bitmap per document.

Lines become 128-bit hashes of their keys, range-partitioned by (hash, document) and sorted by (hash, document, place). One pass over a
partition streams them: the first document of a hash keeps its lines, the others lose theirs. A hash that reaches over partitions, however many
rows it has, is settled by the smallest document of each partition's first and last hash. Texts meet nothing but the bitmap of their own document.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import in_small_batches, own_columns, pieces, texts_of
from lakeops.session import materialize

#: Shorter keys, in code points, never drop a line.
LEAST = 10
#: What a row of the pass says: a line to drop, a line of the partition's first hash, the first document of the partition's last hash.
DROP, OPEN, LAST = 0, 1, 2


def line_key(line: bytes, least: int = LEAST) -> bytes | None:
    """The line in UTF-8 without ASCII space at its ends, A-Z lower-cased; None if it has fewer code points."""
    key = line.strip().lower()
    if len(key) < least or not key.isascii() and len(key) - sum(128 <= b < 192 for b in key) < least:
        return None
    return key


def _line_table(documents: DataFrame, least: int) -> DataFrame:
    """(h1, h2, doc_id, text_hash, line) for each line that has a key."""
    rows = own_columns(documents, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    id_type = documents.schema["doc_id"].dataType
    out = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("doc_id", id_type), T.StructField("text_hash", T.LongType()), T.StructField("line", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        for batch in batches:
            ids, hashes = batch.column(0).cast(schema.field("doc_id").type), batch.column(2)
            for start, raw in pieces(texts_of(batch.column(1))):
                digests, owner, line = [], [], []
                for i, text in enumerate(raw, start):
                    for place, one in enumerate(text.split(b"\n")):
                        if (key := line_key(one, least)) is not None:
                            digests.append(hashlib.blake2b(key, digest_size=16).digest())
                            owner.append(i)
                            line.append(place)
                both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                of = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), ids.take(of), hashes.take(of), pa.array(line, pa.int32())], schema=schema)

    return in_small_batches(rows).mapInArrow(run, out)


def _streamed(lines: DataFrame) -> DataFrame:
    """The rows of sorted partitions that the first document of their hash does not keep, with ``what`` they say."""
    out = T.StructType([*lines.schema.fields, T.StructField("what", T.ByteType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the open hash, its first document, and whether it is the partition's first
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1))], axis=1)
            ids = batch.column(2)
            codes = ids.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
            starts = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            later = codes != codes[starts][group]
            opened = np.zeros(len(keys), bool)
            first = held is None
            if held is not None and (keys[0] == held[0]).all():
                of_held = group == 0
                if held[2]:
                    opened |= of_held
                elif ids[0].as_py() == held[1]:
                    later |= False  # the same first document: codes tell the others
                else:
                    later |= of_held
            elif first:
                opened |= group == 0
            what = np.where(opened, OPEN, DROP).astype(np.int8)
            told = np.flatnonzero(opened | later)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(told)) for c in range(5)], pa.array(what[told])], names=out.names)
            goes_on = held is not None and len(starts) == 1 and (keys[0] == held[0]).all()
            if not goes_on:
                at = int(starts[-1])
                held = (keys[at], ids[at].as_py(), bool(opened[at]), pa.RecordBatch.from_arrays([*[batch.column(c).slice(at, 1) for c in range(5)], pa.array([LAST], pa.int8())], names=out.names))
        if held is not None and not held[2]:
            yield held[3]

    return lines.mapInArrow(run, out)


def dropped_lines(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, text_hash, line) of the lines, numbered from 0, that a document with a smaller id holds as well.

    A line is named by its key: without space, tab and line-feed-like bytes at both ends and with A-Z lower-cased; keys of fewer than
    ``least`` code points drop nothing. Rows with the same id are one document; NULL ids are one document after all others.
    """
    lines = _line_table(documents, least)
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").asc_nulls_last()]
    told = materialize(_streamed(lines.repartitionByRange(*order).sortWithinPartitions(*order, "text_hash", "line")), "line_told")
    edge = told.filter(F.col("what") != DROP).groupBy("h1", "h2").agg(F.min("doc_id").alias("_first"))  # two rows a partition at most
    settled = told.filter(F.col("what") == OPEN).join(F.broadcast(edge), ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("_first")))
    of = ["doc_id", "text_hash", "line"]
    return told.filter(F.col("what") == DROP).select(*of).union(settled.select(*of))


def pack(dropped: np.ndarray) -> bytes:
    """The keep bitmap, compressed, of a document whose lines with these numbers go; lines after its end stay."""
    keep = np.ones((int(dropped.max()) // 8 + 1) * 8, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def unpack(keep: bytes | None, n: int) -> np.ndarray:
    """Which of n lines stay; all of them without a bitmap."""
    out = np.ones(n, bool)
    if keep is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:n].astype(bool)
        out[: len(bits)] = bits
    return out


def keep_bitmaps(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, text_hash, n_dropped, keep) of each different text of an id that loses lines; ``keep`` is read by ``unpack``."""
    own = dropped_lines(documents, least).groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("lines"))
    id_type = documents.schema["doc_id"].dataType
    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("text_hash", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("keep", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sets = [np.asarray(lists.value_lengths()), [pack(np.asarray(x.values)) for x in lists]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets[0], pa.int64()), pa.array(sets[1], pa.binary())], names=out.names)

    return own.mapInArrow(run, out)


def deduplicated_lines(documents: DataFrame, bitmaps: DataFrame | None = None, least: int = LEAST) -> DataFrame:
    """(doc_id, n_lines, n_dropped, keep, kept) for each row: ``kept`` is its text without the dropped lines.

    NULL and empty texts have one empty line and stay. Texts are split at line feeds only; the lines that stay are joined by them, so a text
    that loses all lines becomes empty. Rows that repeat are treated alike. Other columns of ``documents`` are not read.
    """
    bitmaps = keep_bitmaps(documents, least) if bitmaps is None else bitmaps
    marks = bitmaps.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_dropped", "keep")
    rows = own_columns(documents, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    met = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left").select("doc_id", "text", "n_dropped", "keep")
    id_type = documents.schema["doc_id"].dataType
    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("keep", T.BinaryType()), T.StructField("kept", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        for batch in batches:
            keeps = batch.column(3)
            for start, raw in pieces(texts_of(batch.column(1))):
                counts, kept = [], []
                for i, text in enumerate(raw, start):
                    keep = keeps[i].as_py()
                    counts.append(text.count(b"\n") + 1)
                    if keep is not None:
                        lines = text.split(b"\n")
                        text = b"\n".join([lines[j] for j in np.flatnonzero(unpack(keep, len(lines)))])
                    kept.append(text)
                part = batch.slice(start, len(raw))
                gone = part.column(2).fill_null(0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(schema.field("doc_id").type), pa.array(counts, pa.int64()), gone, part.column(3).cast(pa.binary()), pa.array(kept, pa.binary()).cast(pa.string())], schema=schema
                )

    return in_small_batches(met).mapInArrow(run, out)
