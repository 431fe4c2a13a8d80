import base64

import tiktoken

from lakeops.llm.token_histogram import SPLIT, VOCABULARY, length_histogram, length_quantiles, suffix_sums, token_lengths, totals_at


def plain_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def test_lengths_and_round_trip(small):
    docs, texts = small
    plain = plain_encoding()
    made = {r["doc_id"]: r["n_tokens"] for r in token_lengths(docs).collect()}
    for i, t in texts.items():
        tokens = plain.encode_ordinary(t)
        assert made[i] == len(tokens) and plain.decode(tokens) == t


def test_every_answer_equals_a_count_over_documents(small):
    docs, texts = small
    lengths = [r["n_tokens"] for r in token_lengths(docs).collect()]
    sums = suffix_sums(length_histogram(token_lengths(docs)), block=64)
    rows = sums.collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(set(lengths))
    for r in rows:
        limit = r["n_tokens"]
        assert r["docs"] == lengths.count(limit)
        assert r["docs_from"] == sum(x >= limit for x in lengths)
        assert r["tokens_from"] == sum(x for x in lengths if x >= limit)
        assert r["tokens_cut"] == sum(min(x, limit) for x in lengths)
        assert abs(r["quantile"] - sum(x <= limit for x in lengths) / len(lengths)) < 1e-12
    limits = [0, 1, 77, 512, 10**9]
    for r in totals_at(sums, limits).collect():
        assert r["docs_over"] == sum(x > r["context"] for x in lengths) and r["tokens_cut"] == sum(min(x, r["context"]) for x in lengths)
    ordered = sorted(lengths)
    for r in length_quantiles(sums, [0.01, 0.5, 0.9, 1.0]).collect():
        assert r["n_tokens"] == next(x for i, x in enumerate(ordered) if (i + 1) / len(ordered) >= r["share"] and (i + 1 == len(ordered) or ordered[i + 1] != x))


def test_odd_rows(odd_documents, no_documents):
    made = token_lengths(odd_documents).collect()
    assert len(made) == odd_documents.count()
    assert {r["n_tokens"] for r in made if r["doc_id"] in (3, 4, 5)} == {0}
    assert suffix_sums(length_histogram(token_lengths(no_documents))).count() == 0
    assert [(r["docs_over"], r["tokens_cut"]) for r in totals_at(suffix_sums(length_histogram(token_lengths(no_documents))), [5]).collect()] == [(0, 0)]
