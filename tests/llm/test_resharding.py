import random
import zlib

import pytest
from pyspark.sql import functions as F

from lakeops.llm.common import hash_slice
from lakeops.llm.queries import QUERIES
from lakeops.llm.resharding import affected_shards, equal_capacities, minimum_cost_flow, read_shards, reshard, rewrite_shards

ROOT = "/root/testdata/sf0.001"


def test_flow_moves_the_fewest_bytes():
    r = random.Random(3)
    for _ in range(200):
        olds, news = r.randrange(1, 6), r.randrange(1, 6)
        supply = [r.randrange(0, 50) for _ in range(olds)]
        demand = equal_capacities(sum(supply), news)
        flow = minimum_cost_flow(supply, demand, lambda i, j: int(i != j))
        assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(olds)] == supply
        assert [sum(v for (_, j), v in flow.items() if j == k) for k in range(news)] == demand
        assert sum(v for (i, j), v in flow.items() if i != j) == sum(supply) - sum(min(a, b) for a, b in zip(supply, demand))


def test_flow_with_other_costs_equals_every_plan():
    r = random.Random(4)
    for _ in range(60):
        supply = [r.randrange(0, 4) for _ in range(2)]
        demand = [r.randrange(0, sum(supply) + 1)]
        demand.append(sum(supply) - demand[0])
        cost = {(i, j): r.randrange(0, 9) for i in range(2) for j in range(2)}
        flow = minimum_cost_flow(supply, demand, lambda i, j: cost[i, j])
        best = min(
            x * cost[0, 0] + (supply[0] - x) * cost[0, 1] + (demand[0] - x) * cost[1, 0] + (supply[1] - demand[0] + x) * cost[1, 1]
            for x in range(supply[0] + 1) if 0 <= demand[0] - x <= supply[1]
        )
        assert sum(v * cost[k] for k, v in flow.items()) == best


def test_query_is_a_partition_by_bytes(spark):
    rows = QUERIES["op5_min_cost_flow_reshard"](spark, ROOT).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "bytes" and r["grown_shard"] is None
    sizes, largest = [0] * 16, max(r["size"] for r in rows)
    for j in range(16):
        own = [r for r in rows if r["shard"] == j]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        sizes[j] = sum(r["size"] for r in own)
    assert max(sizes) - min(sizes) <= 2 * largest
    old: dict = {}
    for r in rows:
        old[r["old_shard"]] = old.get(r["old_shard"], 0) + r["size"]
    least = sum(max(0, b - sum(sizes) // 16) for b in old.values())
    assert abs(sum(r["size"] for r in rows if r["moved"]) - least) <= 16 * largest


@pytest.mark.parametrize("n", [0, 1, 5, 400])
def test_rows_that_tie_empty_tables_and_files(spark, tmp_path, n):
    rows = spark.range(n).select(F.lit(7).alias("old"), (F.lit(3)).cast("long").alias("size"), F.lit(0).alias("doc_id"), F.lit("x").alias("text"), hash_slice(F.xxhash64(F.lit(1))).alias("_slice"))
    placed = reshard(rows, 4, old="old", size="size", slice_by="_slice", order=["doc_id"])
    made = placed.collect()
    assert len(made) == n
    counts = [sum(r["shard"] == j for r in made) for j in range(4)]
    assert max(counts) - min(counts) <= 1
    if n:
        path = str(tmp_path / "shards")
        rewrite_shards(placed, path, affected_shards(placed, "old"), 0)
        assert read_shards(spark, path, placed.schema).count() == n


@pytest.mark.parametrize("first, second", [(16, 12), (12, 16), (5, 1)])
def test_files_after_growing_and_shrinking(spark, tmp_path, first, second):
    """The files hold every document once, in its shard, after two rewrites of one folder; shards that lose all rows are empty, those of neither side keep their files."""
    path = str(tmp_path / "shards")
    rows = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 7 + 1).alias("size"), F.lit(0).alias("old"), hash_slice(F.xxhash64("id")).alias("_slice"))
    for version, shards in enumerate([first, second]):
        placed = reshard(rows, shards, old="old", size="size", slice_by="_slice", order=["doc_id"])
        placed = placed.cache()
        everywhere = spark.createDataFrame([(j,) for j in range(shards)], "shard int")
        rewrite_shards(placed, path, everywhere if version == 0 else affected_shards(placed, "old"), version)
        stored = read_shards(spark, path, placed.schema)
        assert {(r["doc_id"], r["shard"], r["slot"]) for r in stored.collect()} == {(r["doc_id"], r["shard"], r["slot"]) for r in placed.collect()}
        assert stored.count() == 400
        rows = placed.select("doc_id", "size", F.col("shard").alias("old"), "_slice")
    assert {r[0] for r in stored.select("shard").distinct().collect()} == set(range(second))


def test_a_rewrite_without_commit_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "shards")
    placed = spark.createDataFrame([(1, 0, 0), (2, 1, 0)], "doc_id long, shard int, slot long")
    rewrite_shards(placed, path, placed.select("shard"), 0)
    rewrite_shards(placed.withColumn("shard", F.lit(0)), path, placed.select("shard"), 1)
    (tmp_path / "shards/v=1/_COMMITTED").unlink()
    assert {(r["doc_id"], r["shard"]) for r in read_shards(spark, path, placed.schema).collect()} == {(1, 0), (2, 1)}
