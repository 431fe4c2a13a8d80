"""Spelling variants: words that differ by one edit, found by dense tiles of padded code-point matrices.

Two words differ by exactly one inserted, deleted or replaced code point when their common prefix and common suffix together reach the longer
length less one. Then one of the two covers at least half of that, so words meet in buckets of an equal first or an equal last half, for each
length of the longer word; a pair is counted in its first-half bucket if it has one. Inside tasks, blocks of a bucket's words are laid out as matrices,
aligned at the left for prefixes and at the right for suffixes, and every two blocks are compared as one tile. Only a word's number of
near words and its best one leave a tile.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import in_small_batches, own_columns, pieces, texts_of
from lakeops.session import materialize

LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: One of so many runs, by the checksum of document and run, loses a code point.
EVERY = 31
#: Words of a block; smaller buckets share a tile up to PACKED words.
BLOCK, PACKED = 1_024, 128
#: Words that a task counts before it hands them on.
HELD = 200_000


def edited_runs(doc_id: object, text: bytes, least: int = LEAST_LENGTH, every: int = EVERY) -> Counter:
    """How often each word of at least ``least`` code points occurs, after runs with a checksum that ``every`` divides have lost a code point.

    Runs are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, of which A-Z are lower-cased. The checksum is the crc32 of ``<doc_id>:<run>``.
    """
    words: Counter = Counter()
    prefix = f"{'' if doc_id is None else doc_id}:"
    for run, n in Counter(re.findall(f"[A-Za-zÀ-ÿ]{{{least},}}", text.lower().decode("utf-8", "replace"))).items():
        checksum = zlib.crc32((prefix + run).encode())
        if checksum % every == 0:
            at = checksum % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        words[run] += n
    return words


def vocabulary(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, every: int = EVERY) -> DataFrame:
    """(word, n) for each word that all texts together hold at least ``least_count`` times. A NULL text has no words; a NULL id counts as ''."""
    rows = own_columns(documents, "doc_id", "text").filter(F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column(0)
            for start, raw in pieces(texts_of(batch.column(1))):
                for i, text in enumerate(raw, start):
                    held.update(edited_runs(ids[i].as_py(), text, least_length, every))
                if len(held) >= HELD:
                    yield told()
                    held.clear()
        yield told()

    counted = in_small_batches(rows).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words aligned at the left and at the right, padded by zeros, and the words' lengths."""
    lengths = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    if len(flat) and flat.max() < 256:
        flat = flat.astype(np.uint8)
    width = int(lengths.max())
    inside = np.arange(width)[None, :] < lengths[:, None]
    left, right = np.zeros((2, len(words), width), flat.dtype)
    left[inside] = flat
    right[inside[:, ::-1]] = flat
    return left, right, lengths


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(len(a), len(b)) numbers of equal columns before the first other one; padding is equal to nothing."""
    alive, common = np.ones((len(a), len(b)), bool), np.zeros((len(a), len(b)), np.uint16)
    for c in range(min(a.shape[1], b.shape[1])):
        x = a[:, c]
        alive &= (x[:, None] == b[None, :, c]) & (x != 0)[:, None]
        if not alive.any():
            break
        common += alive
    return common


def near_tile(left: tuple, right: tuple, length: int, half: int, suffix: bool) -> np.ndarray:
    """Which words of one block differ by one edit from which of another, the longer of both having ``length`` code points.

    A pair counts if it shares the first ``half`` code points, and under ``suffix`` if it shares the last ones only.
    """
    (a, ar, na), (b, br, nb) = left, right
    before, behind = _common(a, b), _common(ar[:, ::-1], br[:, ::-1])
    shorter = np.minimum(na[:, None], nb[None, :]).astype(np.uint16)
    longer = np.maximum(na[:, None], nb[None, :]) == length
    near = longer & (before < length) & (before + np.minimum(behind, shorter - before) >= length - 1)
    return near & (before < half) & (behind >= half) if suffix else near & (before >= half)


def _entries(words: DataFrame) -> DataFrame:
    """(length, suffix, half, word, n): each word under the first and the last half that a longer word of its own or the next length may share."""
    size = F.length("word")
    lengths = F.explode(F.array(size, size + 1)).alias("length")
    made = words.select("word", "n", lengths).withColumn("_k", F.expr("length div 2"))
    sides = F.array(
        F.struct(F.lit(False).alias("suffix"), F.expr("substring(word, 1, _k)").alias("half")), F.struct(F.lit(True).alias("suffix"), F.expr("right(word, _k)").alias("half")),
    )
    return made.select("length", F.explode(sides).alias("_s"), "word", "n").select("length", "_s.suffix", "_s.half", "word", "n")


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best) for each word of (word, n) that has a near word: how many, and the one of largest n (ties: smallest word).

    A bucket of more than ``block`` words is dealt to blocks by a hash, and every two blocks of it are a unit of their own, so no bucket is held
    by one task and no pair becomes a row.
    """
    entries = materialize(_entries(words), "spelling_entries")
    key = ["length", "suffix", "half"]
    large = entries.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).withColumn("_blocks", F.ceil(F.col("_n") / block).cast("int"))
    dealt = entries.join(large, key).withColumn("_own", F.pmod(F.xxhash64("word"), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    units = dealt.select(*key, "word", "n", "_own", other).select(*key, F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), F.col("_own").alias("own"), "word", "n")
    sort = [*key, "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        def told(found: list) -> pa.RecordBatch:
            flat = list(zip(*found, strict=True)) if found else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(flat[0], pa.string()), pa.array(flat[1], pa.int64()), pa.array(flat[2], pa.int64()), pa.array(flat[3], pa.string())], names=["word", "n_near", "best_n", "best"])

        def best(near: np.ndarray, own: list[tuple], others: list[tuple], found: list) -> None:
            order = sorted(range(len(others)), key=lambda x: (-others[x][1], others[x][0]))
            ranked = near[:, order]
            first, count = ranked.argmax(axis=1), near.sum(axis=1)
            found.extend((own[x][0], int(count[x]), others[order[first[x]]][1], others[order[first[x]]][0]) for x in np.flatnonzero(count))

        def tile(xs: list[tuple], ys: list[tuple] | None, length: int, suffix: bool, found: list) -> None:
            if len(xs) + len(ys or ()) < 2 or ys is not None and not (xs and ys):
                return
            a = matrices([x[0] for x in xs])
            b = a if ys is None else matrices([y[0] for y in ys])
            near = near_tile(a, b, length, length // 2, suffix)
            best(near, xs, xs if ys is None else ys, found)
            if ys is not None:
                best(near.T, ys, xs, found)

        found: list = []
        packed: list = []
        at = last = None
        for (length, suffix, half, i, j), unit in groupby(rows(), key=lambda r: r[:5]):
            unit = list(unit)
            if i != j:
                tile([(r[6], r[7]) for r in unit if r[5] == i], [(r[6], r[7]) for r in unit if r[5] == j], length, suffix, found)
            else:
                # Whole buckets share a tile; two blocks of one bucket meet in a unit of their own.
                if packed and ((length, suffix) != at or half == last or len(packed) + len(unit) > PACKED):
                    tile(packed, None, *at, found)
                    packed = []
                at, last = (length, suffix), half
                packed += [(r[6], r[7]) for r in unit]
            if len(found) >= 20_000:
                yield told(found)
                found = []
        if packed:
            tile(packed, None, *at, found)
        yield told(found)

    # Narrow rows with much work each: more tasks than their bytes would give.
    tasks = 4 * int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = units.repartition(tasks, *sort).sortWithinPartitions(*sort)
    tiles = parts.mapInArrow(run, "word string, n_near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("_top")
    return tiles.groupBy("word").agg(F.sum("n_near").alias("n_near"), top).select("word", "n_near", (-F.col("_top.m")).alias("best_n"), F.col("_top.w").alias("best"))


def spelling_variants(words: DataFrame, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of a vocabulary (word, n) of distinct words.

    ``form`` is a word's near word of largest n (ties: smallest in code-point order) if that is at least ``times`` its own n, else NULL; ``root``
    is where following forms ends, the word itself without one. Along forms n grows by ``times``, so a chain has at most log(n) steps, and each
    round doubles the steps that are followed. A word of length L has at most about 2 L x letters near words, so no root is hot.
    """
    near = near_words(words, block)
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("best_n") >= times * F.col("n"), F.col("best")).alias("form"), "best_n"
    )
    known = materialize(known, "spelling_forms")
    roots = known.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = materialize(roots.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling_roots")
        roots = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n")
    )
