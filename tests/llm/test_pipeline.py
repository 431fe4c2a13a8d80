from pyspark.sql import functions as F

import corpus_pipeline
from lakeops.llm.queries import ORACLES, QUERIES
from tests.llm.test_bagminhash import plain_classes
from tests.llm.test_decontamination import plain
from lakeops.llm.quality import fit_quality, score_quality

ROOT = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        scores = score_quality(docs, fit_quality(docs, spark.read.parquet(f"{ROOT}/labels.parquet"))).collect() if name == "quality" else []
        stage(spark, docs, ROOT).write.parquet(path := str(tmp_path / name))
        docs = spark.read.parquet(path)
        rows = docs.collect()
        after = {r["doc_id"]: r["text"] for r in rows}
        assert len(after) == len(rows) and all(before[i] == t for i, t in after.items())
        if name == "quality":
            assert set(after) == {r["doc_id"] for r in scores if r["score"] >= 0.3} and len(after) < len(before)
        elif name == "near_duplicates":
            listed = sorted(before.items())
            assert set(after) == {listed[c][0] for c in plain_classes(listed).values()} and len(after) < len(before)
        elif name == "decontaminate":
            judged = {i: plain(t, bench) for i, t in before.items()}
            assert set(after) == {i for i, (n, hit, _) in judged.items() if not (hit and 20 * hit >= n)}
        else:
            assert set(after) == set(before)
        if name == "mix":
            order = [r["doc_id"] for r in docs.selectExpr("_metadata.file_name f", "_metadata.row_index r", "doc_id").orderBy("f", "r").collect()]
        if name == "shard":
            for j in range(16):
                own = sorted((r for r in rows if r["shard"] == j), key=lambda r: r["slot"])
                assert [r["slot"] for r in own] == list(range(len(own)))
                for piece in {r["old_shard"] for r in own}:  # runs of the mix
                    places = [order.index(r["doc_id"]) for r in own if r["old_shard"] == piece]
                    assert places == sorted(places)
        else:
            assert docs.columns == columns
        before = after


def test_every_shard_keeps_the_weights_of_the_mix(spark, tmp_path):
    per = {f"s{i:02}": 1_280 for i in range(19)} | {"hot": 12_160}
    source = F.when(F.col("id") < 12_160, "hot").otherwise(F.format_string("s%02d", F.col("id") % 19))
    docs = spark.range(sum(per.values())).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), source.alias("source"))
    corpus_pipeline.mix(spark, docs, ROOT).write.parquet(path := str(tmp_path / "mix"))
    rows = corpus_pipeline.shard(spark, spark.read.parquet(path), ROOT).collect()
    assert sorted(r["mix_position"] for r in rows) == list(range(sum(per.values())))
    weight = {s: n**0.5 for s, n in per.items()}
    whole, small = sum(weight.values()), weight["s00"]
    most = 1_280 / small * whole  # rows until all sources but the hot one run out

    def fluid(s: str, rows_done: float) -> float:
        return min(rows_done, most) * weight[s] / whole + (max(0, rows_done - most) if s == "hot" else 0)

    mixed = 0
    for j in range(16):
        own = sorted((r for r in rows if r["shard"] == j), key=lambda r: r["slot"])
        assert [r["mix_position"] for r in own] == sorted(r["mix_position"] for r in own)
        pieces = [[r["mix_position"] for r in own if r["old_shard"] == o] for o in {r["old_shard"] for r in own}]
        assert all(p[-1] - p[0] + 1 == len(p) for p in pieces)  # runs of the mix
        for s in per:
            got, want = sum(r["source"] == s for r in own), sum(fluid(s, p[-1] + 1) - fluid(s, p[0]) for p in pieces)
            assert abs(got - want) <= 3 * 32 * len(pieces)
            if own[-1]["mix_position"] < most:
                assert abs(got / len(own) - weight[s] / whole) < 0.05
        mixed += own[-1]["mix_position"] < most
    assert mixed >= 8


def test_odd_and_no_documents(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, ROOT)
            assert set(docs.columns) <= set(made.columns)
            made.collect()


def test_names():
    assert [n.split("_")[0] for n in QUERIES][:13] == [f"op{n}" for n in range(1, 14)] and "pipeline" in QUERIES and set(ORACLES) <= set(QUERIES)
