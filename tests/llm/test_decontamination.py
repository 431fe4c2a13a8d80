import hashlib
import random
import re

from lakeops.llm.decontamination import benchmark_overlap, uncontaminated, words


def plain_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text: str | None, items: list[tuple]) -> tuple[int, int, list[str]]:
    w = plain_words(text)
    hit, found = set(), set()
    for item, body in items:
        b = plain_words(body)
        size = min(13, len(b))
        own = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)} if b else set()
        for i in range(len(w) - size + 1) if own else ():
            if tuple(w[i : i + size]) in own:
                hit.update(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def check(rows, documents, items):
    assert len(rows) == len(documents)
    by_id = {r["doc_id"]: r for r in rows}
    for i, text in documents:
        n, hit, found = plain(text, items)
        r = by_id[i]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(found))
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_words():
    for text in ("", "Ab_c-1 É́x `{y}~\x7fz", "　 a\tb", "Ünï ÀÉ"):
        assert [w.decode() for w in words(text.encode())] == plain_words(text)


def test_made_up_texts_in_blocks(spark):
    r = random.Random(8)
    items = [(i if i % 5 else None, " ".join(r.choice("abcd") for _ in range(r.choice([0, 1, 2, 5, 13, 14, 30])))) for i in range(12)]
    items.append((None, "words that no other item of the benchmark has in any of its windows at all"))
    documents = [(i, " ".join(r.choice("abcd") for _ in range(r.choice([0, 3, 20, 90])))) for i in range(80)]
    for i in range(40):
        body = items[r.randrange(12)][1]
        documents.append((100 + i, documents[i][1] + " " + body + " " + documents[i + 1][1]))
    documents.append((200, documents[0][1] + " " + items[-1][1]))
    docs, bench = spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (7, 200_000):
        check(benchmark_overlap(docs, bench, block=block).collect(), documents, items)
    kept = {x["doc_id"] for x in uncontaminated(docs, bench).collect()}
    judged = {i: plain(t, items) for i, t in documents}
    assert judged[200][1] >= 14 and 200 not in kept
    assert kept == {i for i, (n, hit, _) in judged.items() if not (hit > 0 and 20 * hit >= n)}


def test_given_tables(spark, small):
    docs, texts = small
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    check(benchmark_overlap(docs, bench).collect(), list(texts.items()), [(r["item_id"], r["text"]) for r in bench.collect()])


def test_odd_rows(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, None), (None, "two words"), (2, ""), (3, "TWO words"), (3, "wort wort"), (4, "...")], "item_id long, text string")
    rows = benchmark_overlap(odd_documents, bench).collect()
    assert len(rows) == odd_documents.count()
    assert {r["doc_id"]: r["items"] for r in rows if r["n_items"]} == {7: ["3"], 9: ["3"], 10: ["3"]}
    assert next(r for r in rows if r["doc_id"] == 7)["n_hit"] == 60_000
    assert benchmark_overlap(no_documents, bench).count() == 0
    kept = uncontaminated(odd_documents, bench.limit(0))
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count()
