import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm.language import DIMENSIONS, fit_languages, identify_languages, letter_vector, profiles


def plain_profile(text: str) -> np.ndarray:
    letters = [0]
    for c in text.lower():
        letters += [ord(c)] if c.isalpha() else [0] if letters[-1] else []
    letters += [0] if letters[-1] else []
    out = np.zeros(DIMENSIONS)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        if a or b or c:
            out += np.roll(letter_vector(a, DIMENSIONS), 2) * np.roll(letter_vector(b, DIMENSIONS), 1) * letter_vector(c, DIMENSIONS)
    return out


@pytest.mark.parametrize("text", ["A cat sat.", "x", "", "12 34", "\n\n\nÉté à  la\n\n\n\n", "中文 and ß", "ab" * 500])
def test_profile_is_the_sum_of_bound_letter_vectors(text):
    assert np.array_equal(profiles([b"other", text.encode(), b"\n"])[1], plain_profile(text))


def test_long_text_is_summed_whole():
    text = "abc def " * 120_000
    assert np.linalg.norm(profiles([text.encode()])[0]) > 0.99 * np.linalg.norm(plain_profile("abc def " * 1000)) * 120


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = identify_languages(docs, fit_languages(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = made[made.held_out]
    assert len(made) == docs.count() and len(held) > 100
    assert (held.lang_pred == held.lang).mean() > 0.98


def test_a_rare_language_keeps_its_profile(spark):
    """Drawn at one rate over all rows, a language of 30 in 30,000 would get about one of 1,000 draws."""
    rare = ["kwizz kwozz qwax zzek", "qwox kwazz zzik kwux"]
    rows = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 1_000 == 0, F.lit(rare[0])).otherwise(F.concat(F.lit("the stone carries light "), F.col("id"))).alias("text"),
        F.when(F.col("id") % 1_000 == 0, "rare").otherwise("common").alias("lang"),
    )
    model = fit_languages(rows, fit_rows=1_000, least_rows=20)
    assert model.languages == ("common", "rare")
    texts = spark.createDataFrame([(0, rare[1]), (1, "light of a stone")], "doc_id long, text string")
    assert [r["lang_pred"] for r in identify_languages(texts, model).orderBy("doc_id").collect()] == ["rare", "common"]


def test_predictions_equal_plain_version(spark, small):
    """Prototypes summed and cosines taken one text at a time."""
    docs, texts = small
    langs = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    sums: dict = {}
    made = {i: plain_profile(t or "") for i, t in texts.items() if len(t or "") < 3_000}
    model = fit_languages(docs.filter(F.col("doc_id").isin(list(made))))
    for i, profile in made.items():
        if langs[i] is not None and zlib.crc32(str(i).encode()) % 5:
            sums[langs[i]] = sums.get(langs[i], 0) + profile
    cosine = lambda a, b: float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
    rows = {r["doc_id"]: r for r in identify_languages(docs.filter(F.col("doc_id").isin(list(made))), model).collect()}
    assert len(rows) == len(made) > 100
    for i, profile in made.items():
        if not any(c.isalpha() for c in texts[i] or ""):
            assert rows[i]["lang_pred"] == "und"
            continue
        scores = {lang: cosine(profile, own) for lang, own in sums.items()}
        best = max(sorted(scores), key=scores.get)
        assert abs(rows[i]["score"] - min(1, max(0, scores[best]))) < 1e-6
        assert rows[i]["lang_pred"] == best or scores[best] - scores[rows[i]["lang_pred"]] < 1e-6


def test_odd_rows(odd_documents, no_documents):
    model = fit_languages(odd_documents)
    rows = identify_languages(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {3, 4, 5, None, 8, 11}
    nothing = fit_languages(no_documents)
    assert nothing.languages == ()
    assert {r["lang_pred"] for r in identify_languages(odd_documents, nothing).collect()} == {"und"}
    assert identify_languages(no_documents, model).count() == 0
