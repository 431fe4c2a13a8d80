from collections import Counter

import numpy as np
import pytest

from lakeops.llm import bagminhash
from lakeops.llm.bagminhash import bag_minhash, keep_one, near_duplicates
from tests.llm.conftest import prose


def bag(text: str) -> Counter:
    import re

    w = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", text.lower())
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def alike(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / sum((a | b).values()) if a and b else 0.0


def plain_classes(rows: list[tuple]) -> dict:
    """{place in rows: smallest place that links lead to} with all pairs compared."""
    bags = [bag(t or "") for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] is not None and rows[j][1] is not None and (alike(bags[i], bags[j]) >= 0.8 or not bags[i] and rows[i][1] == rows[j][1]):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: find(i) for i in range(len(rows))}


@pytest.mark.parametrize("n,counts", [(60, 1), (60, 5), (4, 40), (1, 3)])
def test_signatures_estimate_weighted_jaccard(n, counts):
    r, errors = np.random.default_rng(n), []
    for _ in range(60):
        h = r.integers(0, 2**63, n, dtype=np.uint64)
        a, b = r.integers(1, counts + 1, n), r.integers(1, counts + 1, n)
        a[: n // 4], b[n // 2 :] = a[: n // 4], np.where(r.random(n - n // 2) < 0.6, a[n // 2 :], b[n // 2 :])
        s = bag_minhash(np.concatenate([h, h]), np.concatenate([a, b]), np.repeat([0, 1], n), 2, 125)
        errors.append(np.mean(s[0] == s[1]) - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 4 * 0.045 / np.sqrt(60) and np.sqrt(np.mean(np.square(errors))) < 0.065


def variants(seed: int, n: int, copies: int, changes: int) -> list[str]:
    base = prose(seed, n).split()
    out = []
    for c in range(copies):
        w = list(base)
        for k in range(changes):
            w[(c * 37 + k * 101) % n] = f"new{c}x{k}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [1_000, 7])
def test_classes_equal_all_pairs(spark, small, monkeypatch, block):
    """Buckets with base texts, variants that are alike only to some of the others, copies and shared passages; also in small blocks."""
    monkeypatch.setattr(bagminhash, "BLOCK_TEXTS", block)
    _, texts = small
    more = variants(901, 160, 40, 1) + variants(902, 200, 60, 3) + [prose(903, 80)] * 25 + [" ".join([prose(904, 60), prose(905 + i, 200)]) for i in range(30)]
    rows = [*texts.items(), *((10_000 + i, t) for i, t in enumerate(more))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = {r["doc_id"]: r for r in near_duplicates(docs).collect()}
    want = plain_classes(rows)
    assert {i: r["class_id"] for i, r in made.items()} == {rows[i][0]: min(rows[j][0] for j in want if want[j] == c) for i, c in want.items()}
    sizes = Counter(want.values())
    assert all(made[rows[i][0]]["n_copies"] == sizes[c] for i, c in want.items())
    assert sorted(r["doc_id"] for r in keep_one(docs).collect()) == sorted({r["class_id"] for r in made.values()})


def test_odd_rows(odd_documents, no_documents):
    rows = near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    of = {}
    for r in rows:
        of.setdefault(r["doc_id"], set()).add((r["class_id"], r["n_copies"]))
    assert of[1] == {(1, 3), (1, 1)} and of[2] == {(1, 3)} and of[3] == {(3, 1)} and of[4] == of[5] == {(4, 2)} and of[10] == {(9, 2)}
    assert of[None] == {(None, 2), (None, 1)}
    kept = keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted((str(r["doc_id"]), len(r["text"] or "")) for r in kept.collect()).__len__() == 17 - 2 - 1 - 1 - 1
    assert near_duplicates(no_documents).count() == 0 and keep_one(no_documents).count() == 0


def test_small_buckets_become_no_pairs(spark, monkeypatch):
    """Texts of several groups that meet in small buckets: no join makes their pairs, whose number grows with the square of a bucket, and no link is lost."""
    few = []
    plain = bagminhash.likely_in_small
    monkeypatch.setattr(bagminhash, "likely_in_small", lambda rows, *a: few.append(rows) or plain(rows, *a))
    rows = [(i, t) for i, t in enumerate(t for s in range(12) for t in variants(300 + s, 120, 6, 2))]
    made = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_classes(rows)
    assert made == {i: min(j for j in want if want[j] == c) for i, c in want.items()}
    assert few and few[0].count() > 0


def test_likely_pairs_of_small_buckets(spark):
    sketch = lambda *values: np.array(values, np.uint16).tobytes()
    alike, other = sketch(*range(20)), sketch(*range(100, 120))
    near = sketch(*range(18), 90, 91)
    few = spark.createDataFrame([(1, b"c", b"c"), (1, b"a", b"a"), (1, b"b", b"a"), (1, b"d", b"d"), (2, b"a", b"a"), (2, b"c", b"c")], "bucket long, key binary, `group` binary")
    nodes = spark.createDataFrame([(b"a", alike), (b"b", near), (b"c", near), (b"d", other)], "key binary, sketch binary")
    got = bagminhash.likely_in_small(few, nodes, 0.8)
    assert sorted((bytes(r["a"]), bytes(r["b"])) for r in got.collect()) == [(b"a", b"c"), (b"b", b"c")]


def test_blocks_return_links_that_join(spark):
    """Texts of a bucket that are all alike and all groups of their own: fewer links than texts, not one for every two; those that are alike to none stay out."""
    n = 40
    rows = [(i, t) for i, t in enumerate([*variants(701, 200, n, 1), prose(702, 150), prose(703, 150)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys, bags = bagminhash.multisets([t.encode() for _, t in rows], 5)
    nodes = spark.createDataFrame([(k, i, len(b)) for i, (k, b) in enumerate(zip(keys, bags, strict=True))], "key binary, first_id long, n_shingles long")
    mixed = spark.createDataFrame([(7, k, k, i > 0) for i, k in enumerate(keys)], "bucket long, key binary, `group` binary, apart boolean")
    links = [(bytes(r["a"]), bytes(r["b"])) for r in bagminhash.links_in_blocks(mixed, nodes, docs, 0.8, 5).collect()]
    assert len(links) <= 2 * (n - 1)  # two units: those apart and the largest group, those apart among themselves
    assert len(joined_by(links)) == 1 and joined_by(links)[0] == set(keys[:n])


def joined_by(links: list[tuple]) -> list[set]:
    out: list[set] = []
    for a, b in links:
        met = [s for s in out if a in s or b in s]
        out = [s for s in out if s not in met] + [{a, b}.union(*met)]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_joining_links(seed):
    r = np.random.default_rng(seed)
    alike = r.random((r.integers(1, 30), r.integers(1, 30))) < r.choice([0.02, 0.1, 0.9])
    left, right = r.integers(0, 20, alike.shape[0]), r.integers(0, 20, alike.shape[1])
    links = [(int(a), int(b)) for a, b in bagminhash.joining(alike, left, right)]
    every = {(int(left[i]), int(right[j])) for i, j in zip(*np.nonzero(alike), strict=True) if left[i] != right[j]}
    assert set(links) <= every and sorted(map(sorted, joined_by(links))) == sorted(map(sorted, joined_by(list(every))))
    assert len(links) == sum(len(s) - 1 for s in joined_by(links))


def graphs() -> dict[str, list[tuple]]:
    r = np.random.default_rng(3)
    path = r.permutation(90).tolist()
    return {
        "random": [tuple(map(int, p)) for p in r.integers(0, 150, (140, 2))], "chain": [(i, i + 1) for i in range(200)], "star": [(50, i) for i in range(100)],
        "odd": [(1, 1), (2, None), (None, 3), (5, 4), (4, 5), (5, 4), (4, 5)], "none": [], "shuffled chain": [*zip(path, path[1:], strict=False)],
    }


@pytest.mark.parametrize("name", list(graphs()))
def test_components(spark, monkeypatch, name):
    """Groups are those of the links, and of the links only those between groups that are still apart go on to the next round."""
    from lakeops.llm import components

    written, plain = [], components.materialize

    def told(df, label):
        made = plain(df, label)
        written.append((label, made.count()))
        return made

    monkeypatch.setattr(components, "materialize", told)
    links = graphs()[name]
    got = {r["key"]: r["group"] for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    whole = [x for x in links if None not in x]
    assert got == {k: min(s) for s in joined_by(whole) for k in s}
    edges = [n for label, n in written if label == "component_edges"]
    assert edges[-1] == 0 and sum(edges) <= 2 * len({tuple(sorted(x)) for x in whole})
    assert len(written) <= 25


def test_merged_groups(spark):
    from lakeops.llm.components import between, merged

    groups = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5)], "key long, `group` long")
    links = spark.createDataFrame([(2, 1), (6, 2), (9, 5), (5, 9), (8, 7)], "a long, b long")
    assert sorted(map(tuple, between(links, groups).collect())) == [(1, 5), (5, 9), (7, 8)]
    over = spark.createDataFrame([(1, 1), (5, 1), (9, 1), (7, 7), (8, 7)], "key long, `group` long")
    assert sorted(map(tuple, merged(groups, over).collect())) == [(1, 1), (2, 1), (5, 1), (6, 1), (7, 7), (8, 7), (9, 1)]
