import math
import struct
import zlib

import numpy as np
import xxhash
import zstandard

from lakeops.llm.quality import QualityModel, fit_quality, good_documents, logistic_curve, score_quality, size_difference
from tests.llm.conftest import prose


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_held_out_rows_are_told_apart(spark):
    root = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")
    made = score_quality(docs, fit_quality(docs, labels)).join(labels, "doc_id").toPandas()
    held = made[made.held_out]
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(made.doc_id, made.held_out))
    assert auc(held.score.values, held.quality.values) > 0.97
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert (good >= 0.3).mean() > 0.98 and (bad < 0.3).mean() > 0.7
    # The curve is calibrated: what it says on average is what is true.
    assert abs(held.score.mean() - held.quality.mean()) < 0.05


def test_sizes_and_curve():
    model = QualityModel(prose(1, 2000).encode(), b"#!" * 3000, 0.0, 1.0, 2048, 3)
    assert size_difference(b"", model) == 0
    assert size_difference(prose(2, 300).encode(), model) > 0 > size_difference(b"#!" * 500, model)
    long = prose(2, 300).encode() * 400
    assert size_difference(long, model) > 0  # judged in chunks to its end
    x = np.linspace(-1, 1, 400)
    a, b = logistic_curve(x, (x > 0.2).astype(float))
    assert abs(-a / b - 0.2) < 0.05 and logistic_curve(np.array([]), np.array([])) == (0.0, 0.0)


def spark_hash(*values: int) -> int:
    """Spark's xxhash64 of numbers: longs of 8 bytes and ints, given as such, of 4, each seeded by the hash before."""
    seed = 42
    for v in values:
        raw = struct.pack("<i", int(v)) if isinstance(v, np.int32) else struct.pack("<q", v)
        seed = xxhash.xxh64(raw, seed=seed % 2**64).intdigest()
    return seed - 2**64 if seed >= 2**63 else seed


def test_every_score_equals_a_plain_recomputation(spark):
    """Draws, chunks, dictionaries, compressed sizes and the curve in plain Python over the smallest tables."""
    root = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    marks = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 5}
    unit = lambda i, role: spark_hash(i, np.int32(role)) % 2**30 / 2**30
    curve = [i for i in marks if texts.get(i) and unit(i, 2) < 1 / 3]
    samples: dict = {0: [], 1: []}
    for i, label in marks.items():
        if texts.get(i) and i not in curve:
            samples[label] += [(spark_hash(i, np.int32(n)), texts[i][at : at + 2048]) for n, at in enumerate(range(0, len(texts[i]), 2048))]
    dictionary = {}
    for label, own in samples.items():
        chunks = [c for _, c in sorted(own)][:4_000]
        size = sum(map(len, chunks))
        if len(chunks) >= 50 and size >= 8_192:
            dictionary[label] = zstandard.train_dictionary(min(65_536, size // 4), chunks, k=200, d=8).as_bytes()
        else:
            dictionary[label] = b"\n".join(chunks)[-65_536:]

    def packed(text: bytes, label: int) -> int:
        made = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary[label]), write_checksum=False, write_content_size=False, write_dict_id=False)
        return sum(len(made.compress(text[at : at + 2048])) for at in range(0, len(text), 2048))

    difference = {i: (packed(t, 0) - packed(t, 1)) / len(t) if t else 0.0 for i, t in texts.items()}
    scale = float(np.std([difference[i] for i in curve]))

    def loss(a: float, b: float) -> float:
        """Penalised log likelihood, of which the fitted curve is the maximum."""
        total = -0.005 * b * b
        for i in curve:
            z = a + b * difference[i] / scale
            total += (z if marks[i] else 0.0) - (math.log1p(math.exp(-abs(z))) + max(z, 0.0))
        return total

    model = fit_quality(docs, labels)
    a, b = model.intercept, model.slope * scale
    assert b > 0 and len(curve) > 10
    top = loss(a, b)
    assert all(loss(a + x, b + y) <= top + 1e-9 for x in (-0.05, 0, 0.05) for y in (-0.05, 0, 0.05))
    for r in score_quality(docs, model).collect():
        assert abs(r["size_difference"] - difference[r["doc_id"]]) < 1e-12
        assert abs(r["score"] - 1 / (1 + math.exp(-(a + b * difference[r["doc_id"]] / scale)))) < 1e-9


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (4, None), (99, 7), (7, 1)], "doc_id long, quality int")
    model = fit_quality(odd_documents, labels)
    rows = score_quality(odd_documents, model).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    assert good_documents(odd_documents, model, 0.0).columns == odd_documents.columns
    assert good_documents(odd_documents, model, 0.0).count() == odd_documents.count()
    none = fit_quality(no_documents, labels.limit(0))
    assert len({r["score"] for r in score_quality(odd_documents, none).collect()}) == 1
    assert score_quality(no_documents, model).count() == 0
