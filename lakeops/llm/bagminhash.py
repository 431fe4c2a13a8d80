"""Near-duplicate documents by BagMinHash signatures of their multisets of word shingles.

Every distinct shingle of a document is a Poisson process over (time, signature component, weight). Weights are
discretised to whole counts, and the process is split into the weight intervals (0, 1], (1, 2], (2, 4], (4, 8] and
so on; a shingle that occurs c times takes the points at weights up to c. A component's value is its first point, so
two documents agree in a component with a probability of exactly their weighted Jaccard similarity. A process
is followed only until its time passes the latest of the document's first points.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import hash_buckets, in_buckets, in_small_batches, map_texts, packed
from lakeops.llm.components import between, connected, merged
from lakeops.llm.shingles import mix, shingles_of, words_of
from lakeops.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
#: Buckets up to this size are compared as one row each, larger ones in blocks.
SMALL = 8
#: Texts and bytes of shingles of a block of a larger bucket.
BLOCK_TEXTS, BLOCK_BYTES = 1_000, 32_000_000
#: Signatures whose share of equal components is this far below the threshold are not verified: over four standard errors.
MARGIN = 0.15


def bag_minhash(hashes: np.ndarray, counts: np.ndarray, owner: np.ndarray, n: int, m: int) -> np.ndarray:
    """(n, m) signatures of n multisets given by (element, count, owner) triples; infinite for an empty one."""
    seeds, docs, lows, widths, caps = [mix(hashes)], [owner], [np.zeros(len(hashes))], [np.ones(len(hashes))], [counts]
    low = 1
    while len(more := np.flatnonzero(counts > low)):
        seeds.append(mix(hashes[more] + np.uint64(low * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)))
        docs.append(owner[more])
        lows.append(np.full(len(more), float(low)))
        widths.append(np.full(len(more), float(low)))
        caps.append(counts[more])
        low *= 2
    seed, doc, low, width, cap = (np.concatenate(x) for x in (seeds, docs, lows, widths, caps))
    best = np.full(n * m, np.inf)
    latest = np.full(n, np.inf)
    time, step, ahead, rounds = np.zeros(len(seed)), 0, 1, 0
    while len(seed):
        turn = np.arange(step, step + ahead, dtype=np.uint64) * np.uint64(0x9E6C63D0876A9A47)
        drawn = mix(seed[:, None] + turn[None, :])
        gaps = -np.log1p(-((drawn >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / (m * width)[:, None]
        gaps[:, 0] += time
        times = np.cumsum(gaps, axis=1)
        second = mix(drawn ^ np.uint64(0xA0761D6478BD642F))
        component = ((second >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        weight = low[:, None] + width[:, None] * ((second & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32)
        counted = (weight < cap[:, None]) & (times < latest[doc][:, None])
        np.minimum.at(best, (doc[:, None] * m + component)[counted], times[counted])
        touched = np.unique(doc)
        latest[touched] = best.reshape(n, m)[touched].max(axis=1)
        time = times[:, -1]
        on = time < latest[doc]
        seed, doc, low, width, cap, time = (x[on] for x in (seed, doc, low, width, cap, time))
        step, rounds = step + ahead, rounds + 1
        ahead = min(16, 1 << rounds // 3)  # few are left after some rounds, and these have far to go
    return best.reshape(n, m)


def multisets(texts: list[bytes], size: int) -> tuple[list[bytes], list[np.ndarray]]:
    """A 16-byte key of each text's word sequence, and its sorted shingle hashes with repeats.

    A text without words is keyed by its bytes.
    """
    words = words_of(texts)
    bags = shingles_of(words, size)
    keys = []
    for i, text in enumerate(texts):
        own = words.hashes[words.offsets[i] : words.offsets[i + 1]]
        keys.append(hashlib.blake2b(own.tobytes() if len(own) else b"\x00" + text, digest_size=16).digest())
    return keys, [np.sort(bags.hashes[bags.offsets[i] : bags.offsets[i + 1]]) for i in range(len(texts))]


def signed(texts: list[bytes], size: int, bands: int, rows: int) -> dict:
    """Columns key, n_shingles, bands, sketch for each text; no bands for a text without words."""
    keys, bags = multisets(texts, size)
    m = bands * rows
    parts = [np.unique(b, return_counts=True) for b in bags]
    owner = np.repeat(np.arange(len(bags)), [len(p[0]) for p in parts])
    signature = bag_minhash(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), owner, len(bags), m)
    bits = mix(signature.view(np.uint64))
    grouped = bits.reshape(-1, bands, rows)
    band = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(bags), 1))
    for r in range(rows):
        band = mix(band + grouped[:, :, r])
    band, short = band.view(np.int64), (bits & np.uint64(0xFFFF)).astype(np.uint16)
    return {
        "key": keys, "n_shingles": [len(b) for b in bags],
        "bands": [band[i] if len(b) else [] for i, b in enumerate(bags)], "sketch": [short[i].tobytes() if len(b) else b"" for i, b in enumerate(bags)],
    }


def _alike(left: bytes, right: bytes) -> float:
    """Weighted Jaccard similarity of two multisets, each as sorted 64-bit hashes with repeats."""
    (a, na), (b, nb) = (np.unique(np.frombuffer(x, np.uint64), return_counts=True) for x in (left, right))
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = int(np.minimum(na[i], nb[j]).sum())
    return both / (int(na.sum()) + int(nb.sum()) - both) if both else 0.0


def _compared(df: DataFrame, left: str, right: str, measure, name: str) -> DataFrame:
    """(a, b, name) from rows with two binary columns."""

    def run(batches):
        for batch in batches:
            x, y = batch.column(batch.schema.get_field_index(left)), batch.column(batch.schema.get_field_index(right))
            made = [measure(p.as_py(), q.as_py()) for p, q in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("a")), batch.column(batch.schema.get_field_index("b")), pa.array(made, pa.float64())], names=["a", "b", name])

    return in_small_batches(df).mapInArrow(run, T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField(name, T.DoubleType())]))


def _agreement(left: bytes, right: bytes) -> float:
    x, y = np.frombuffer(left, np.uint16), np.frombuffer(right, np.uint16)
    return float(np.mean(x == y)) if len(x) and len(x) == len(y) else 0.0


def bags_of(keys: DataFrame, nodes: DataFrame, documents: DataFrame, size: int) -> DataFrame:
    """(key, bag): the sorted shingle hashes of the texts with some keys, which are fetched by an id of each and keyed again."""
    ids = nodes.join(keys, "key", "left_semi").select(F.col("first_id").alias("_id")).distinct()
    rows = documents.filter(F.col("text").isNotNull()).select("doc_id", "text")
    rows = in_buckets(rows, "doc_id", hash_buckets(ids, "_id")).join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")

    def work(texts: list[bytes]) -> dict:
        made, bags = multisets(texts, size)
        return {"key": made, "bag": [b.tobytes() for b in bags]}

    bags = map_texts(rows, work, [("key", T.BinaryType()), ("bag", T.BinaryType())])
    return materialize(bags.groupBy("key").agg(F.first("bag").alias("bag")), "bag_texts")


def verified(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, threshold: float, size: int) -> DataFrame:
    """The pairs (a, b) of keys whose multisets are as alike as the threshold, with their similarity.

    Pairs first meet the short sketches; only what stays is compared by whole texts.
    """
    sketches = nodes.select("key", "sketch")
    met = pairs.join(sketches.select(F.col("key").alias("a"), F.col("sketch").alias("_x")), "a").join(sketches.select(F.col("key").alias("b"), F.col("sketch").alias("_y")), "b")
    likely = _compared(met, "_x", "_y", _agreement, "agreement").filter(F.col("agreement") >= threshold - MARGIN).select("a", "b")
    return confirmed(materialize(likely, "bag_likely"), nodes, documents, threshold, size)


def confirmed(likely: DataFrame, nodes: DataFrame, documents: DataFrame, threshold: float, size: int) -> DataFrame:
    """The same for pairs whose sketches are alike: whole texts decide."""
    bags = bags_of(likely.select(F.col("a").alias("key")).union(likely.select("b")).distinct(), nodes, documents, size)
    met = likely.join(bags.select(F.col("key").alias("a"), F.col("bag").alias("_x")), "a").join(bags.select(F.col("key").alias("b"), F.col("bag").alias("_y")), "b")
    return _compared(met, "_x", "_y", _alike, "similarity").filter(F.col("similarity") >= threshold)


def links_in_blocks(mixed: DataFrame, nodes: DataFrame, documents: DataFrame, threshold: float, size: int) -> DataFrame:
    """Links (a, b) between the groups of a bucket: texts ``apart`` from its largest group are compared with all of other groups, exactly.

    A bucket's texts are dealt to blocks of about BLOCK_TEXTS texts and BLOCK_BYTES bytes, the largest group's and the others' each on their own, and
    every two blocks of which one is apart meet in a task, as a product of two matrices. So no pair becomes a row, and a
    bucket with few texts apart takes a number of tasks that follows its size. ``a`` and ``b`` are groups, and a task returns
    only links that join what its others leave apart: fewer than it has groups, not one for every two.
    """
    weighed = mixed.join(nodes.select("key", "n_shingles"), "key")
    per = weighed.groupBy("bucket", "apart").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("n_shingles") * 8).alias("_b"))
    per = per.groupBy("bucket").agg(*[
        F.coalesce(F.max(F.when(F.col("apart") == side, F.ceil(F.greatest(F.col("_n") / BLOCK_TEXTS, F.col("_b") / BLOCK_BYTES)))), F.lit(1)).alias(name)
        for side, name in ((True, "_aparts"), (False, "_mains"))
    ])
    dealt = weighed.join(per, "bucket").withColumn("_own", F.pmod(F.xxhash64("key", "bucket"), F.when(F.col("apart"), F.col("_aparts")).otherwise(F.col("_mains"))))
    aparts, mains = F.sequence(F.lit(0).cast("long"), F.col("_aparts") - 1), F.sequence(F.lit(0).cast("long"), F.col("_mains") - 1)
    with_main = F.transform(mains, lambda j: F.struct(F.col("_own").alias("i"), j.alias("j"), F.lit(False).alias("both")))
    with_apart = F.transform(aparts, lambda j: F.struct(F.least("_own", j).alias("i"), F.greatest("_own", j).alias("j"), F.lit(True).alias("both")))
    of_main = F.transform(aparts, lambda i: F.struct(i.alias("i"), F.col("_own").alias("j"), F.lit(False).alias("both")))
    units = dealt.select("bucket", "key", "group", "apart", "_own", F.explode(F.when(F.col("apart"), F.concat(with_main, with_apart)).otherwise(of_main)).alias("unit"))
    bags = bags_of(mixed.select("key").distinct(), nodes, documents, size)
    rows = units.join(bags, "key")

    def meet(unit: pd.DataFrame) -> pd.DataFrame:
        first = unit["unit"].iloc[0]
        left = unit["apart"] & (unit["_own"] == first["i"])
        right = (unit["apart"] & (unit["_own"] == first["j"])) if first["both"] else ~unit["apart"]
        x, y = unit[left], unit[right]
        found: list = []
        if len(x) and len(y):
            common, nx, ny = common_elements([np.frombuffer(b, np.uint64) for b in x["bag"]], [np.frombuffer(b, np.uint64) for b in y["bag"]])
            alike = common >= threshold * (nx[:, None] + ny[None, :] - common)
            groups, codes = np.unique([*x["group"], *y["group"]], return_inverse=True)
            found = [(min(groups[i], groups[j]), max(groups[i], groups[j])) for i, j in joining(alike, codes[: len(x)], codes[len(x) :])]
        return pd.DataFrame(found, columns=["a", "b"])

    return rows.groupBy("bucket", "unit").applyInPandas(meet, "a binary, b binary").distinct()


def joining(alike: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between the groups of the rows (``left``) and columns (``right``) of a matrix that join as much as all its true cells, none of them twice."""
    label = np.arange(max(left.max(), right.max()) + 1)
    links = []
    for one, row in zip(left, alike, strict=True):
        others = right[row]
        tops, first = np.unique(label[others], return_index=True)
        new = tops != label[one]
        if new.any():
            links += [(one, other) for other in others[first[new]]]
            label[np.isin(label, tops)] = label[one]
    return links


def common_elements(left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many elements each left and each right multiset have in common, and their sizes. A repeat of an element is an element of its own."""
    bags = [*left, *right]
    sizes = np.array([len(b) for b in bags])
    owner = np.repeat(np.arange(len(bags)), sizes)
    flat = np.concatenate(bags)
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(flat)), 0))
    elements = mix(flat + (np.arange(len(flat)) - first).astype(np.uint64) * np.uint64(0x9E6C63D0876A9A47))
    seen, place, times = np.unique(elements, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1  # an element of one text is common to none
    keep = times[place] > 1
    owner, column, n = owner[keep], column[place[keep]], int((times > 1).sum())
    common = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, n, 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        dense = np.zeros((len(bags), min(4096, n - low)), np.float32)
        dense[owner[a:b], column[a:b] - low] = 1
        common += dense[: len(left)] @ dense[len(left) :].T
    return common.astype(np.float64), sizes[: len(left)], sizes[len(left) :]


def likely_in_small(few: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of texts of other groups in small buckets whose sketches are alike, once each.

    A bucket with its few sketches is one row, and its texts are compared in the task: texts travel once a bucket, and only alike pairs become rows.
    """
    texts = few.join(nodes.select("key", "sketch"), "key").groupBy("bucket").agg(F.collect_list(F.struct("key", "group", "sketch")).alias("texts"))

    def run(batches):
        for batch in batches:
            left, right = [], []
            for bucket in batch.column(0).to_pylist():
                bucket.sort(key=lambda t: t["key"])
                for i, one in enumerate(bucket):
                    for other in bucket[i + 1 :]:
                        if one["group"] != other["group"] and _agreement(one["sketch"], other["sketch"]) >= threshold - MARGIN:
                            left.append(one["key"])
                            right.append(other["key"])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

    return in_small_batches(texts.select("texts")).mapInArrow(run, "a binary, b binary").distinct()


def near_duplicates(documents: DataFrame, **parameters) -> DataFrame:
    """(doc_id, class_id, n_copies) for each row of ``documents``; the parameters are those of ``duplicate_classes``.

    ``class_id`` is the smallest doc_id of the row's class and ``n_copies`` its rows. A NULL text is alone, its class
    is its own id. NULL ids come after all others; class_id is NULL in a class without any other id.
    """
    labelled = duplicate_classes(documents, **parameters)
    of = labelled.groupBy("group").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_copies"))
    out = labelled.join(of, "group").select("doc_id", "class_id", "n_copies")
    alone = documents.filter(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("n_copies"))
    return out.union(alone)


def duplicate_classes(
    documents: DataFrame, *, threshold: float = THRESHOLD, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, small: int = SMALL
) -> DataFrame:
    """(doc_id, text_hash, key, group) for each row of ``documents`` whose text is not NULL.

    Rows whose shingle multisets are linked by chains of weighted Jaccard similarities of ``threshold`` or more share
    a group. Words are compared without case and punctuation. A text of fewer words than a shingle, but not none, is one
    shingle; texts without words are grouped when they are equal. ``key`` is the text's word sequence.

    Equal word sequences collapse before anything is compared. Two different texts become candidates when a
    band of their signatures agrees: with 25 bands of 5, a pair at 0.8 is missed with probability 5e-5, at 0.85 with
    1e-6. Every text of a bucket meets its leader first, drawn by a hash that is the same in all buckets. Only buckets that then hold
    several groups go on: in those of at most ``small`` texts all pairs between groups are compared inside a row, in larger ones texts outside the
    largest group meet every text of another group, in blocks. No partner is capped.
    """
    texts = documents.filter(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    made = map_texts(
        texts, lambda raw: signed(raw, size, bands, rows), [("key", T.BinaryType()), ("n_shingles", T.LongType()), ("bands", T.ArrayType(T.LongType())), ("sketch", T.BinaryType())],
    )
    made = materialize(made, "bag_signatures")
    nodes = materialize(made.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "bag_nodes")
    spread = nodes.select("key", F.explode("bands").alias("bucket"))
    # The leader has the smallest hash of its own, so the buckets of a cluster share it and their pairs with it are the same.
    turn = F.struct(F.xxhash64("key").alias("h"), F.col("key").alias("key"))
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(turn).alias("_lead")).filter("n > 1")
    members = materialize(spread.join(shared, "bucket").select("bucket", "key", "n", F.col("_lead.key").alias("lead")), "bag_buckets")
    star = members.filter(F.col("key") != F.col("lead")).select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b"))
    links = materialize(verified(materialize(star.distinct(), "bag_pairs"), nodes, documents, threshold, size).select("a", "b"), "bag_links")
    groups = connected(links)

    # What is left are buckets whose texts are not in one group yet, and in these the pairs between groups.
    grouped = members.select("bucket", "key", "n").join(groups, "key", "left").withColumn("group", F.coalesce("group", "key"))
    sizes = grouped.groupBy("bucket", "group").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "group")).alias("_most"), F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    mixed = materialize(grouped.join(main.select("bucket", F.col("_most.group").alias("_main")), "bucket").withColumn("apart", F.col("group") != F.col("_main")).drop("_main"), "bag_mixed")
    few, large = mixed.filter(F.col("n") <= small), mixed.filter(F.col("n") > small).drop("n")
    more = []
    if not few.isEmpty():
        likely = materialize(likely_in_small(few, nodes, threshold).join(star, ["a", "b"], "left_anti"), "bag_likely")
        more.append(materialize(between(confirmed(likely, nodes, documents, threshold, size).select("a", "b"), groups), "bag_links"))
    if not large.isEmpty():
        more.append(materialize(links_in_blocks(large, nodes, documents, threshold, size), "bag_links"))
    if more:
        groups = merged(groups, connected(reduce(DataFrame.union, more)))
    return made.select("doc_id", "text_hash", "key").join(groups, "key", "left").select("doc_id", "text_hash", "key", F.coalesce("group", "key").alias("group"))


def keep_one(documents: DataFrame, **parameters) -> DataFrame:
    """``documents`` without all but one row of each group of near duplicates, with its columns as they are.

    The row with the smallest id stays (NULL last); of rows that repeat that id in the group, the one with the smallest
    text hash, then the smallest hash of all columns. NULL texts all stay.
    """
    labelled = materialize(duplicate_classes(documents, **parameters), "bag_classes")
    same = labelled.groupBy("group", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "n")).alias("first")
    of = materialize(same.groupBy("group").agg(first, F.sum("n").alias("n_copies")).filter("n_copies > 1"), "bag_first")
    ids = labelled.join(of, "group", "left_semi").select("doc_id")
    buckets = materialize(hash_buckets(ids, "doc_id"), "bag_ids")
    rows = packed(documents, "doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").isNull().alias("no_text"))
    touched = in_buckets(rows, "doc_id", buckets)
    clear = in_buckets(rows, "doc_id", buckets, "left_anti")

    # Rows that share a bucket with a grouped id: drop those of a group that are not its first.
    same_row = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")) & ~F.col("no_text")
    drop = labelled.join(of, "group").filter(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))))
    drop = drop.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    stays = touched.join(drop, same_row, "left_anti")
    repeated = of.filter("first.n > 1").select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    if repeated.isEmpty():
        return clear.union(stays).select("_row.*")
    again = stays.join(repeated, same_row, "left_semi").withColumn("_turn", F.xxhash64("_row"))
    picked = again.groupBy("doc_id", "text_hash").agg(F.min_by("_row", "_turn").alias("_row"))
    return clear.union(stays.join(repeated, same_row, "left_anti")).select("_row.*").union(picked.select("_row.*"))
