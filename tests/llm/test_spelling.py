import re
import zlib
from collections import Counter

import pytest

from lakeops.llm.spelling import near_words, spelling_variants, vocabulary


def plain_vocabulary(rows: list[tuple]) -> dict:
    words: Counter = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(words: dict) -> dict:
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


def made(words) -> dict:
    rows = spelling_variants(words).collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_whole_query_equals_all_pairs(spark, small):
    docs, texts = small
    words = plain_vocabulary(list(texts.items()))
    assert {r["word"]: r["n"] for r in vocabulary(docs).collect()} == words and len(words) > 500
    from lakeops.llm.queries import QUERIES

    rows = QUERIES["op12_spelling_variants"](spark, "/root/testdata/sf0.001").collect()
    want = plain_variants(words)
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows} == want and len(rows) == len(want)
    assert sum(w[3] > 0 for w in want.values()) > 50


@pytest.mark.parametrize("block", [1_024, 5])
def test_dense_neighbourhoods(spark, block):
    """Words over few letters, many of which are near each other, so that buckets reach over many blocks; chains of forms; ties; short and other words."""
    state, words = 1, {}
    for k in range(700):
        state = (state * 1103515245 + 12345) % 2**31
        size = 3 + (state >> 9) % 8
        words["".join("abé"[(state >> (10 + 2 * i)) % 4 % 3] for i in range(size))] = 10 ** (k % 5) + k % 3
    words |= {"a": 5, "": 3, "naïveté": 10_000, "naivété": 900, "naiveté": 1_000, "naivete": 90, "naivet": 8, "𝔘nicode": 40, "unicode": 400, "nicode": 3}
    want = plain_variants(words)
    listed = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in near_words(listed, block).collect()}
    assert {w: g[0] for w, g in got.items()} == {w: x[3] for w, x in want.items() if x[3]}
    assert made(listed) == want
    assert want["naivet"][1] == "naïveté"


def test_odd_and_no_documents(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    words = plain_vocabulary(rows)
    assert {r["word"]: r["n"] for r in vocabulary(odd_documents).collect()} == words
    assert made(vocabulary(odd_documents)) == plain_variants(words)
    assert spelling_variants(vocabulary(no_documents)).count() == 0
