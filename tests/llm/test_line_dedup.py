import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lakeops.llm.line_dedup import deduplicated_lines, keep_bitmaps, unpack


def plain(rows: list[tuple]) -> list[tuple]:
    """(doc_id, lines, dropped, kept text) for each (doc_id, text); ids sort with None last."""
    place = lambda i: (i is None, i or 0)

    def key(line: str) -> str:
        stripped = re.sub("^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$", "", line)
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in stripped)

    holders: dict = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)], key=place) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def made(docs) -> list[tuple]:
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in deduplicated_lines(docs).collect()), key=str)


ODD = [
    (3, "A line of Text\n\tshared by some \r\nshort\nA line of text"), (1, "  a LINE of text\nÄÖÜäöü long\nshort"), (2, "äöüäöü long\nshared by some"), (2, "shared by some\nanother one here"),
    (7, None), (8, ""), (9, "\n\n"), (None, "another one here\nonly without id"), (None, "only without id"), (4, "123456789\n1234567890"), (5, "123456789\n1234567890\n"), (5, "123456789\n1234567890\n"),
    (6, "éééééééé9\néééééééé10\nx \nnine chars"), (11, "éééééééé9\néééééééé10"),
]


@pytest.mark.parametrize("partitions", [1, 7])
def test_equals_plain_version(spark, small, partitions):
    """Also with a line that a third of the documents hold, more often than one partition has rows."""
    _, texts = small
    rows = [*((i + 100, t) for i, t in texts.items()), *ODD, *((1_000 + i, f"the hot line again\nline {i} alone") for i in range(400)), *((2_000 + i, "the hot line again\n" * 5) for i in range(20))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert made(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_bitmaps(spark):
    rows = [(1, "\n".join(f"line number {i}" for i in range(100))), (2, "\n".join(f"line number {i}" if i % 3 else f"own line {i}!!" for i in range(100)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    (mark,) = keep_bitmaps(docs).collect()
    assert mark["doc_id"] == 2 and mark["n_dropped"] == 66 and list(unpack(mark["keep"], 100)) == [i % 3 == 0 for i in range(100)]
    assert unpack(None, 3).all()


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert made(odd_documents) == plain(rows)
    assert deduplicated_lines(no_documents).count() == 0
    names = spark.createDataFrame([("b", "the same line"), ("a", "the same line"), (None, "the same line")], "doc_id string, text string")
    assert made(names) == plain([(1, ""), (2, ""), (3, "")])[:0] + [("a", 1, 0, "the same line"), ("b", 1, 1, ""), (None, 1, 1, "")]


def test_query_digest(spark):
    from lakeops.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in plain([(r["doc_id"], r["text"]) for r in docs.collect()])}
    got = QUERIES["op11_range_line_dedup"](spark, "/root/testdata/sf0.001")
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got.collect()} == want
    assert got.filter(F.col("n_dropped") > 0).count() > 0
