import random

import pytest

from lakeops.llm.mixing import exact_schedule, mixed_documents, mixed_order, source_weights


def deviation(order: list, shares: dict) -> float:
    slots, seen, most = sum(shares.values()), dict.fromkeys(shares, 0), 0.0
    for t, (source, _) in enumerate(order, 1):
        seen[source] += 1
        most = max(most, *(abs(seen[s] - t * n / slots) for s, n in shares.items()))
    return most


def test_every_source_stays_within_a_block_of_its_share():
    r = random.Random(2)
    for _ in range(300):
        shares = {f"s{i}": r.choice([1, 1, 2, 7, 30, 300]) for i in range(r.randrange(1, 9))}
        order = list(exact_schedule({s: (n, n) for s, n in shares.items()}))
        assert sorted(order) == sorted((s, k) for s, n in shares.items() for k in range(n))
        assert deviation(order, shares) < 1
        slots = sum(shares.values())
        for at, (s, k) in enumerate(order):  # inside its window
            assert k * slots // shares[s] <= at < -(-(k + 1) * slots // shares[s])


def test_documents(spark, small):
    docs, texts = small
    rows = mixed_order(docs, source_weights(docs), block_rows=2).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert len({(r["slot"], r["place"]) for r in rows}) == len(rows)
    slots = {}
    for r in rows:
        slots.setdefault(r["slot"], set()).add((r["source"], r["block"]))
    assert sorted(slots) == list(range(len(slots))) and all(len(x) == 1 for x in slots.values())


def test_files_follow_the_schedule(spark, small, tmp_path):
    docs, _ = small
    order = {r["doc_id"]: (r["slot"], r["place"]) for r in mixed_order(docs, source_weights(docs)).collect()}
    mixed_documents(docs, source_weights(docs)).write.parquet(path := str(tmp_path / "mixed"))
    seen = spark.read.parquet(path).selectExpr("_metadata.file_name f", "_metadata.row_index r", "doc_id").orderBy("f", "r").collect()
    assert [r["doc_id"] for r in seen] == sorted(order, key=order.get)


def test_odd_rows(spark, odd_documents, no_documents):
    weights = spark.createDataFrame([("a", 2.0), (None, 1.0), ("b", None), ("gone", 5.0)], "source string, weight double")
    rows = mixed_order(odd_documents, weights, block_rows=2).collect()
    assert len(rows) == odd_documents.count()
    weighed = [r["slot"] for r in rows if r["source"] in ("a", None)]
    assert max(weighed) < min(r["slot"] for r in rows if r["source"] in ("b", "c"))
    mixed = mixed_documents(odd_documents, weights)
    assert mixed.columns == odd_documents.columns and mixed.count() == odd_documents.count()
    assert mixed_order(no_documents, weights).count() == 0 and mixed_documents(no_documents, source_weights(no_documents)).count() == 0


@pytest.mark.parametrize("n", [1, 3, 20, 1500])
def test_exact_weights_hold_for_any_number_of_sources(n):
    r = random.Random(n)
    sources = {f"s{i}": (r.choice([1.0, 2**0.5, 0.001, 7 / 3, 40.0]), r.randrange(1, 40)) for i in range(n)}
    sources["hot"] = ((20.0 * n) ** 0.5, 20 * n)
    made = list(exact_schedule(sources))
    assert sorted(made) == sorted((s, k) for s, (_, b) in sources.items() for k in range(b))
    # Virtual time at each slot: rates are the weights of the sources that have blocks left in the fluid schedule.
    ends = sorted((b / w, w) for w, b in sources.values())
    v, rate, at, times = 0.0, sum(w for w, _ in sources.values()), 0, [0.0]
    for _ in made:
        need = 1.0
        while at < len(ends) and need > (ends[at][0] - v) * rate:
            need -= (ends[at][0] - v) * rate
            v, rate, at = ends[at][0], rate - ends[at][1], at + 1
        if at < len(ends):
            v += need / rate
        times.append(v)
    for slot, (s, k) in enumerate(made):
        w, b = sources[s]
        assert k + 1 - min(b, w * times[slot + 1]) < 1 + 1e-6 and min(b, w * times[slot]) - k < 1 + 1e-6


def test_documents_of_many_sources_follow_the_given_weights(spark):
    few = [(i, "t", f"big{i % 5}") for i in range(3_000)]
    docs = spark.createDataFrame([*few, *[(3_000 + i, "t", f"one{i % 1200}") for i in range(2_400)]], "doc_id long, text string, source string")
    given = {**{f"big{i}": 100.0 for i in range(5)}, **{f"one{i}": 1.0 for i in range(1200)}}
    weights = spark.createDataFrame(list(given.items()), "source string, weight double")
    rows = mixed_order(docs, weights, block_rows=1).collect()
    assert len(rows) == 5_400
    for upto in (170, 850, 1_700):  # no source has run out
        seen: dict = {}
        for r in rows:
            if r["slot"] < upto:
                seen[r["source"]] = seen.get(r["source"], 0) + 1
        assert all(abs(seen.get(s, 0) - upto * w / 1_700) < 1 for s, w in given.items())
