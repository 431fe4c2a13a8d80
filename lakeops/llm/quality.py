"""Quality scores by compression with dictionaries trained on good and on bad text.

Two zstandard dictionaries are trained, one from texts labelled good and one from texts labelled bad. A text is
cut into chunks, every chunk is compressed with both, and the difference of the compressed sizes, divided by the
size of the text, is turned into a probability by a logistic curve fitted on labelled rows that no dictionary saw.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import held_out, keep_texts, map_texts, own_columns, unit
from lakeops.session import materialize


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and the curve ``1 / (1 + exp(-(intercept + slope * difference)))``. Its size is fixed by the fit's parameters."""

    good: bytes
    bad: bytes
    intercept: float
    slope: float
    chunk: int
    level: int


#: Held by a worker process: {model: its two compressors}.
_COMPRESSORS: dict = {}


def _compressors(model: QualityModel) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    if model not in _COMPRESSORS:
        _COMPRESSORS.clear()
        made = []
        for raw in (model.good, model.bad):
            held = zstandard.ZstdCompressionDict(raw)
            held.precompute_compress(level=model.level)
            made.append(zstandard.ZstdCompressor(dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False))
        _COMPRESSORS[model] = tuple(made)
    return _COMPRESSORS[model]


def size_difference(text: bytes, model: QualityModel) -> float:
    """(bytes with the bad dictionary - bytes with the good one) / bytes of the text, over all chunks; 0 for an empty text."""
    if not text:
        return 0.0
    good, bad = _compressors(model)
    total = 0
    for at in range(0, len(text), model.chunk):
        part = text[at : at + model.chunk]
        total += len(bad.compress(part)) - len(good.compress(part))
    return total / len(text)


def curve_at(difference: float, model: QualityModel) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.intercept + model.slope * difference))))


def logistic_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Intercept and slope of P(y = 1 | x), with a light penalty on the slope so that separable data end too."""
    if not len(x):
        return 0.0, 0.0
    scale = float(np.std(x)) or 1.0
    z, a, b = x / scale, 0.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a + b * z, -30, 30)))
        w = p * (1 - p) + 1e-9
        grad = np.array([np.sum(y - p), np.sum((y - p) * z) - 0.01 * b])
        hess = np.array([[np.sum(w) + 1e-6, np.sum(w * z)], [np.sum(w * z), np.sum(w * z * z) + 0.01]])
        step = np.linalg.solve(hess, grad)
        a, b = a + float(np.clip(step[0], -3, 3)), b + float(np.clip(step[1], -3, 3))
        if float(np.abs(step).max()) < 1e-9:
            break
    return a, b / scale


def fit_quality(
    documents: DataFrame, labels: DataFrame, *, fit_rows: int = 12_000, fit_chunks: int = 4_000, chunk: int = 2_048,
    dictionary_bytes: int = 65_536, level: int = 3,
) -> QualityModel:
    """Learn from labelled rows whose id's crc32 modulo 5 is not 0.

    Bounds of the fit: about ``fit_rows`` labelled rows are drawn by a hash of their id (all, when there are fewer).
    Two thirds give chunks, of which ``fit_chunks`` per label are used, again by hash; one third fits the curve.
    So the driver gets at most ``2 * fit_chunks * chunk`` bytes of text and a number for each row of the curve.
    Labels other than 0 and 1 and labels without an id are ignored; a document labelled twice gets the majority,
    1 in a tie. With no label of one kind, both dictionaries come from the other and every score is the same.
    """
    marks = (
        own_columns(labels, "doc_id", "quality").filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    )
    n = marks.count()
    drawn = marks.filter(unit(F.col("doc_id"), F.lit(1)) < min(1.0, fit_rows / max(1, n))).withColumn("_role", unit(F.col("doc_id"), F.lit(2)) < 1 / 3)
    # Bounded: about fit_rows rows of an id and two small numbers.
    texts = materialize(own_columns(documents, "doc_id", "text").filter(F.length("text") > 0).join(F.broadcast(drawn), "doc_id"), "quality_fit")
    raw = F.encode("text", "UTF-8")
    chunks = texts.filter(~F.col("_role")).select(
        "doc_id", "quality", raw.alias("_raw"), F.posexplode(F.sequence(F.lit(1), F.octet_length("text"), F.lit(chunk))).alias("_at", "_from")
    ).select("quality", F.substring("_raw", F.col("_from"), F.lit(chunk)).alias("chunk"), F.xxhash64("doc_id", "_at").alias("_order"))
    samples = {}
    for label in (0, 1):
        rows = chunks.filter(F.col("quality") == label).orderBy("_order", "chunk").limit(fit_chunks).select("chunk").collect()
        samples[label] = [bytes(r[0]) for r in rows]
    for label in (0, 1):
        samples[label] = samples[label] or samples[1 - label]
    dicts = {label: train_dictionary(samples[label], dictionary_bytes) for label in (0, 1)}
    plain = QualityModel(dicts[1], dicts[0], 0.0, 0.0, chunk, level)
    curve = map_texts(texts.filter("_role").select("quality", "text"), lambda raw: {"difference": [size_difference(t, plain) for t in raw]}, [("difference", T.DoubleType())])
    rows = curve.orderBy("difference", "quality").collect()
    intercept, slope = logistic_curve(np.array([r["difference"] for r in rows], float), np.array([r["quality"] for r in rows], float))
    return QualityModel(dicts[1], dicts[0], intercept, max(0.0, slope), chunk, level)


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train one."""
    held = sum(map(len, samples))
    if len(samples) >= 50 and held >= 8 * 1024:
        return zstandard.train_dictionary(min(size, held // 4), samples, k=200, d=8).as_bytes()
    return (b"\n".join(samples)[-size:] or b"\n" * 16).rjust(16, b"\n")


def score_quality(documents: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, held_out, size_difference, score) for each row, over whole texts.

    An empty text, NULL too, has difference 0, so its score is the curve's at 0. Repeated rows are scored each.
    """

    def work(raw: list[bytes]) -> dict:
        differences = [size_difference(t, model) for t in raw]
        return {"size_difference": differences, "score": [curve_at(d, model) for d in differences]}

    rows = own_columns(documents, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    return map_texts(rows, work, [("size_difference", T.DoubleType()), ("score", T.DoubleType())])


def good_documents(documents: DataFrame, model: QualityModel, least: float = 0.3) -> DataFrame:
    """``documents``, with their columns as they are, whose score is ``least`` or more."""
    return keep_texts(documents, lambda raw: [curve_at(size_difference(t, model), model) >= least for t in raw])
