"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A run of three letters is the product of the
letters' vectors, the first rotated by two places and the second by one; a text is the sum of its runs' vectors,
and a language the sum of its texts. A text gets the language whose vector has the largest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import held_out, in_small_batches, map_texts, own_columns, pieces, texts_of, unit

DIMENSIONS = 1024
SEED = 7_919
#: Characters that are turned into vectors at once; longer texts are summed over parts of so many.
PART = 400_000
#: Letters whose vectors a worker keeps.
_KEPT_LETTERS = 20_000
_LETTERS: dict[tuple[int, int], np.ndarray] = {}


def letter_vector(code: int, dimensions: int) -> np.ndarray:
    """+1 and -1 at random, always the same for a letter; code 0 stands for whatever parts words."""
    key = (code, dimensions)
    if key not in _LETTERS:
        if len(_LETTERS) >= _KEPT_LETTERS:
            _LETTERS.clear()
        random = np.random.Generator(np.random.Philox(key=SEED + code))
        _LETTERS[key] = (random.integers(0, 2, dimensions, dtype=np.int8) * 2 - 1).astype(np.float32)
    return _LETTERS[key]


def _parts(texts: list[bytes]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of texts, or one part of a long one, with the text each belongs to; a text's parts overlap by two characters."""
    group: list[str] = []
    owner: list[int] = []
    size = 0
    for i, raw in enumerate(texts):
        text = raw.decode("utf-8", "replace").lower()
        for at in range(0, max(1, len(text) - 2), PART):
            part = text[at : at + PART + 2]
            if size and size + len(part) > PART:
                yield owner, group
                group, owner, size = [], [], 0
            group.append(part)
            owner.append(i)
            size += len(part)
    if group:
        yield owner, group


def profiles(texts: list[bytes], dimensions: int = DIMENSIONS) -> np.ndarray:
    """(texts, dimensions): the sum of the vectors of each text's letter runs; all 0 for a text without letters.

    Whatever lies between letters counts as one separator, and so do the text's two ends.
    """
    out = np.zeros((len(texts), dimensions), np.float64)
    for owner, parts in _parts(texts):
        codes = np.frombuffer("".join(f"\n{p}\n" for p in parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(p) + 2 for p in parts])
        belongs = np.repeat(np.arange(len(parts)), lengths)
        present = np.flatnonzero(np.bincount(codes))
        kinds = np.zeros(present[-1] + 1, np.int64)
        for c in present:
            kinds[c] = c if chr(c).isalpha() else 0
        letters = kinds[codes]
        keep = letters > 0
        keep[1:] |= letters[:-1] > 0
        keep[np.cumsum(lengths) - lengths] = True
        letters, belongs = letters[keep], belongs[keep]
        alphabet = np.flatnonzero(np.bincount(letters))
        numbers = np.zeros(alphabet[-1] + 1, np.int64)
        numbers[alphabet] = np.arange(len(alphabet))
        letter = numbers[letters]
        n = len(alphabet)
        run = (letter[:-2] * n + letter[1:-1]) * n + letter[2:]
        inside = (belongs[:-2] == belongs[2:]) & ((letters[:-2] > 0) | (letters[1:-1] > 0) | (letters[2:] > 0))
        run, whose = run[inside], belongs[:-2][inside]
        if not len(run):
            continue
        if n**3 <= 1 << 22:
            seen = np.bincount(run, minlength=n**3)
            runs = np.flatnonzero(seen)
            lookup = np.zeros(n**3, np.int64)
            lookup[runs] = np.arange(len(runs))
            index = lookup[run]
        else:
            runs, index = np.unique(run, return_inverse=True)
        vectors = np.stack([letter_vector(int(c), dimensions) for c in alphabet])
        once, twice = np.roll(vectors, 1, axis=1), np.roll(vectors, 2, axis=1)
        made = np.zeros((len(owner), dimensions), np.float32)
        width = max(1, (1 << 22) // max(1, len(owner), dimensions))
        for low in range(0, len(runs), width):
            some = runs[low : low + width]
            these = (index >= low) & (index < low + width) if len(runs) > width else slice(None)
            counts = np.bincount(whose[these] * len(some) + index[these] - low, minlength=len(owner) * len(some)).reshape(len(owner), len(some))
            made += counts.astype(np.float32) @ (twice[some // (n * n)] * once[some // n % n] * vectors[some % n])
        for k, i in enumerate(owner):
            out[i] += made[k]
    return out


@dataclass(frozen=True)
class LanguageModel:
    """A profile for each language: languages x dimensions numbers."""

    languages: tuple[str, ...]
    prototypes: np.ndarray


def fit_languages(documents: DataFrame, *, fit_rows: int = 20_000, least_rows: int = 500, dimensions: int = DIMENSIONS) -> LanguageModel:
    """Sum the profiles of documents with a lang, whose id's crc32 modulo 5 is not 0.

    About ``fit_rows`` of them are used, drawn by a hash of the id and text, but about ``least_rows`` of each language, or all where it has fewer:
    a rare language keeps its profile at any size. The driver gets one vector for each language. A NULL or empty text has no letters and
    adds nothing.
    """
    rows = own_columns(documents, "doc_id", "text", "lang").filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    per = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    whole = F.sum("_n").over(Window.partitionBy(F.lit(0)))  # over a row for each language
    rates = per.select("lang", F.greatest(F.lit(fit_rows) / whole, F.lit(least_rows) / F.col("_n")).alias("_rate"))
    met = rows.join(F.broadcast(rates), "lang")
    drawn = met.filter(unit(F.col("doc_id"), F.xxhash64("text")) < F.col("_rate")).select("lang", "text")

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for start, raw in pieces(texts_of(batch.column(1))):
                made = profiles(raw, dimensions)
                for lang in set(langs[start : start + len(raw)]):
                    own = [i for i in range(len(raw)) if langs[start + i] == lang]
                    total[lang] = total.get(lang, 0) + made[own].sum(axis=0)
        for lang, vector in total.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * dimensions, "at": list(range(dimensions)), "value": vector})

    sums = in_small_batches(drawn).mapInArrow(run, "lang string, at long, value double").groupBy("lang", "at").agg(F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for r in sums.toLocalIterator():
        found.setdefault(r["lang"], np.zeros(dimensions))[r["at"]] = r["value"]
    names = tuple(sorted(found))
    return LanguageModel(names, np.stack([found[x] for x in names]) if names else np.zeros((0, dimensions)))


def identify_languages(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, margin) for each row of ``documents``, from its whole text only.

    ``score`` is the cosine with the language's profile, 0 at least, and ``margin`` what it is ahead of the next language's. Ties go to
    the language whose name is first. ``und`` with score 0 for a NULL text, one without letters, and when no language is known.
    """
    size = np.linalg.norm(model.prototypes, axis=1, keepdims=True)
    unit_prototypes = model.prototypes / np.where(size > 0, size, 1)

    def work(raw: list[bytes]) -> dict:
        made = profiles(raw, model.prototypes.shape[1])
        length = np.linalg.norm(made, axis=1)
        cosines = made @ unit_prototypes.T / np.where(length > 0, length, 1)[:, None]
        known = (length > 0) & (len(model.languages) > 0)
        best = cosines.argmax(axis=1) if len(model.languages) else np.zeros(len(raw), int)
        ordered = np.sort(cosines, axis=1)
        return {
            "lang_pred": [model.languages[b] if k else "und" for b, k in zip(best, known, strict=True)],
            "score": [min(1.0, max(0.0, float(o[-1]))) if k else 0.0 for o, k in zip(ordered, known, strict=True)],
            "margin": [float(o[-1] - o[-2]) if k and len(o) > 1 else 0.0 for o, k in zip(ordered, known, strict=True)],
        }

    rows = own_columns(documents, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    return map_texts(rows, work, [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("margin", T.DoubleType())])
