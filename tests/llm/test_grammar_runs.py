import hashlib
import re
import zlib

import numpy as np
import pytest

from lakeops.llm.grammar_runs import grammar, periodic_runs, runs_of


def plain_runs(words: list, least: int = 12) -> list[tuple]:
    """All periods from the smallest on; a stretch that an earlier period has already is not its own."""
    n, seen, out = len(words), set(), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def changed(doc_id, text: str | None) -> list[str]:
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def collapsed(words: list, runs: list) -> str:
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_texts(seed: int, n: int) -> list[list[int]]:
    r = np.random.default_rng(seed)
    out = [[], [1], [1] * 11, [1] * 12, [1] * 200, [1, 2] * 40 + [1], list(range(50))]
    for _ in range(n):
        letters, size = int(r.integers(1, 6)), int(r.integers(0, 120))
        text = list(r.integers(0, letters, size))
        for _ in range(int(r.integers(0, 4))):
            at, p, k = int(r.integers(0, len(text) + 1)), int(r.integers(1, 20)), int(r.integers(2, 9))
            text[at:at] = list(r.integers(0, 9, p)) * k + [int(r.integers(0, 9))]
        out.append(text)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    thue = [0]
    while len(thue) < 512:
        thue += [1 - x for x in thue]
    return [*out, fib[-1], thue, thue + thue]


@pytest.mark.parametrize("least", [12, 5, 2])
@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_all_periods(seed, least):
    texts = random_texts(seed, 120)
    flat = np.array([w for t in texts for w in t], np.int64)
    got = runs_of(flat, np.concatenate([[0], np.cumsum([len(t) for t in texts])]), least)
    for text, runs in zip(texts, got, strict=True):
        assert runs == plain_runs(text, least)


def test_grammar_derives_its_text():
    texts = random_texts(9, 40)
    symbols = np.unique([k * 100 + w for k, t in enumerate(texts) for w in t], return_inverse=True)[1]
    of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    kind, start, middle, end, text = grammar(symbols, of)
    says: dict = {}
    for k, s, m, e, t in zip(kind, start, middle, end, text, strict=True):
        assert s < m < e and (of[s:e] == t).all()
        assert says.setdefault(int(k), (tuple(symbols[s:m]), tuple(symbols[m:e]))) == (tuple(symbols[s:m]), tuple(symbols[m:e]))
    spans = {(s, e) for s, e in zip(start, end, strict=True)}
    for t, words in enumerate(texts):
        if len(words) > 1:
            first = int(np.searchsorted(of, t))
            assert (first, first + len(words)) in spans
    assert len(says) < len(kind)


def digest(runs: list, words: list) -> tuple:
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


def test_query_equals_plain_version(spark, small):
    _, texts = small
    from lakeops.llm.queries import QUERIES

    rows = QUERIES["op13_grammar_runs"](spark, "/root/testdata/sf0.001").collect()
    got = {r["doc_id"]: (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"], r["collapsed_sha256"]) for r in rows}
    want = {}
    for i, text in texts.items():
        words = changed(i, text)
        want[i] = digest(plain_runs(words) if len(words) < 1_500 else runs_by_distance(words), words)
    assert got == want and sum(w[0] > 0 for w in want.values()) > 10


def runs_by_distance(words: list) -> list[tuple]:
    """As ``plain_runs``, for long texts: compares the text with itself by each distance as arrays."""
    ids = np.unique(words, return_inverse=True)[1]
    seen, out = set(), []
    for q in range(1, len(ids) // 2 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ids[:-q] == ids[q:], [False]]).astype(np.int8)))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if j + q - i >= max(12, 2 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_odd_rows(spark, odd_documents, no_documents):
    rows = periodic_runs(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        if r["doc_id"] in (3, 4, 5, None) and not r["collapsed"]:
            assert r["runs"] == []
        if r["doc_id"] == 7:
            assert [tuple(x) for x in r["runs"]] == [(0, 60_000, 1)] and r["collapsed"] == "wort"
        if r["doc_id"] == 12:
            assert [tuple(x) for x in r["runs"]] == [(0, 40, 1)]
    assert periodic_runs(no_documents).count() == 0
