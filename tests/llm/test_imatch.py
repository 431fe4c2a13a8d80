import hashlib
import math
import re

import xxhash

from lakeops.llm.imatch import BAND, HALVINGS, edited_fingerprints


def signed(n: int) -> int:
    return n - 2**64 if n >= 2**63 else n


def part_hash(term: str, k: int) -> int:
    """Spark's xxhash64 of the hash of a term, a long, and a 32-bit number."""
    whole = xxhash.xxh64_intdigest(term.encode(), 42)
    return signed(xxhash.xxh64_intdigest(k.to_bytes(4, "little"), xxhash.xxh64_intdigest(whole.to_bytes(8, "little"), 42)))


def terms(text: str) -> set[str]:
    return {t for t in re.split(r"[^\w]|_", text.lower()) if t}


def plain(rows: list[tuple]) -> list[tuple]:
    """(id, edited hash, own terms by part, edited terms by part) by the definition."""
    texts = [(i, t or "") for i, t in rows]
    n = len(texts)
    df: dict[str, int] = {}
    for _, t in texts:
        for c in terms(t):
            df[c] = df.get(c, 0) + 1
    kept = {c for c, x in df.items() if 2.0 ** BAND[0] <= n / x <= 2.0 ** BAND[1]}
    parts = lambda t: [frozenset(c for c in terms(t) & kept if part_hash(c, k) % 2**h == 0) for k, h in enumerate(HALVINGS)]
    out = []
    for at, (i, t) in enumerate(texts):
        following = texts[(at + 1) % n][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        likeness = lambda a, b, x, y: 1.0 if x == y else (lambda known: sum(p == q for p, q in known) / len(known) if known else 0.0)([(p, q) for p, q in zip(a, b) if p or q])
        own, new, after = parts(t), parts(edited), parts(following)
        out.append((i, hashlib.sha256(edited.encode()).hexdigest(), likeness(own, new, t, edited), likeness(own, after, t, following)))
    return out


def test_against_the_definition(small):
    docs, texts = small
    made = {r["doc_id"]: r for r in edited_fingerprints(docs).collect()}
    assert len(made) == len(texts)
    for i, sha, near_edited, near_next in plain(sorted(texts.items())):
        r = made[i]
        assert r["edited_sha256"] == sha and r["n_chars"] == len(texts[i])
        assert math.isclose(r["near_edited"], near_edited) and math.isclose(r["near_next"], near_next)
    by_text: dict[str, set] = {}
    for i, t in texts.items():
        by_text.setdefault(t, set()).add(made[i]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())


def test_odd_rows(odd_documents, no_documents, spark):
    rows = edited_fingerprints(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert {r["n_chars"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    assert edited_fingerprints(no_documents).count() == 0
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    assert edited_fingerprints(one).first()["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
