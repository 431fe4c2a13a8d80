"""The learner: its scores separate held-out rows, its margins and half-ensembles are those of its trees, a saved model is the same model."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lakeops.operators import scoring as L

NAMES = ["x", "y", "noise"]


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(1)
    made = []
    for i in range(1_500):
        x, y, noise = (float(v) for v in r.normal(size=3))
        made.append((i, x, y, noise, int(x * y + 0.1 * r.normal() > 0), i % 5 == 0))
    return spark.createDataFrame(made, "id int, x double, y double, noise double, won int, is_test boolean").cache()


@pytest.fixture(scope="module")
def model(rows):
    return L.train_trees(rows.filter("not is_test"), NAMES, "won", rounds=12, depth=4)


def test_held_out_auc(model, rows):
    """A product of two numbers decides, which no single column tells; with its noise an AUC of 0.9 is well within reach, of chance 0.5."""
    held_out = L.auc(L.score(model, rows.filter("is_test"), NAMES), "won").first()["auc"]
    assert held_out > 0.9
    assert abs(L.auc(rows.filter("is_test").withColumn("probability", F.col("noise")), "won").first()["auc"] - 0.5) < 0.1


def test_importance_finds_the_deciding_columns(spark, model):
    found = L.feature_importance(model, spark, NAMES).collect()
    assert {r["feature"] for r in found[:2]} == {"x", "y"} and found[2]["importance"] < 0.25
    assert [r["rank"] for r in found] == [1, 2, 3] and abs(sum(r["importance"] for r in found) - 1) < 1e-9


def test_margins_and_half_ensembles_are_those_of_the_trees(model, rows):
    scored = L.score(model, rows.filter("id < 40"), NAMES)
    trees, weights = model.stages[-1].trees, model.stages[-1].treeWeights
    spread = L.ensemble_spread(model, L.tree_margins(model, scored), samples=20, seed=7)
    pick = np.random.default_rng(7)
    drawn = [pick.choice(12, size=6, replace=False) for _ in range(20)]
    for r in spread.collect():
        own = [w * t.predict(Vectors.dense([r["x"], r["y"], r["noise"]])) for w, t in zip(weights, trees, strict=True)]
        assert r["margins"] == pytest.approx(own, abs=1e-12)
        assert 1 / (1 + np.exp(-2 * sum(own))) == pytest.approx(r["probability"], abs=1e-9)
        assert r["spread"] == pytest.approx(np.std([1 / (1 + np.exp(-np.mean([own[t] for t in d]))) for d in drawn]), abs=1e-9)
    assert "Python" not in spread._jdf.queryExecution().executedPlan().toString()


def test_saved_model_scores_alike(spark, model, rows, tmp_path):
    root = str(tmp_path / "models")
    L.save_model(model, root, "2024-01-01")
    weaker = L.train_trees(rows.filter("not is_test"), NAMES, "won", rounds=1, depth=1)
    L.save_model(weaker, root, "2023-12-31")
    score = lambda m: {r["id"]: r["probability"] for r in L.score(m, rows.filter("is_test"), NAMES).collect()}
    assert score(L.latest_model(spark, root)) == score(model) != score(weaker)


def test_sparse_features_of_many_categories(spark):
    """A hundred thousand categories, NULL, and values that the fit has not seen."""
    rows = spark.range(100_000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("c"), (F.col("id") % 2).alias("flag"), F.when(F.col("id") != 5, F.col("id") / 10).alias("n"))
    fitted = L.sparse_features(rows, ["c"], ["n"], ["flag"])
    some = spark.createDataFrame([("c7", 1, 0.5), ("unseen", 0, None), (None, None, 2.0), ("c99999", 1, 3.0)], "c string, flag int, n double")
    vectors = [r["features"] for r in fitted.transform(some).collect()]
    index = {v: i for i, v in enumerate(sorted(f"c{i}" for i in range(100_000)))}
    assert {v.size for v in vectors} == {100_003}
    assert [dict(zip(v.indices.tolist(), v.values.tolist(), strict=True)) for v in vectors] == [
        {index["c7"]: 1.0, 100_001: 0.5, 100_002: 1.0}, {100_000: 1.0}, {100_000: 1.0, 100_001: 2.0}, {index["c99999"]: 1.0, 100_001: 3.0, 100_002: 1.0},
    ]


def test_even_parts(spark):
    cores = spark.sparkContext.defaultParallelism
    parts = lambda n: L.even_parts(spark.range(n))
    assert parts(0) == parts(15_000) == 1 and parts(40_000) == min(2, cores) and parts(200_000 * cores) == cores and parts(200_000 * cores + 1) == 2 * cores


def test_training_rows_lie_in_even_parts(spark, tmp_path, monkeypatch):
    """The split goes by class, which left a part for each; most customers are of one class here."""
    from lakeops.queries import scores as S
    from lakeops.queries.registry import Tables

    n, given = 80_000, []
    customers = spark.range(n).select(F.col("id").alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment"), F.rand(1).alias("c_acctbal"))
    customers.write.parquet(str(tmp_path / "customer.parquet"))
    orders = spark.range(n // 10).select(F.col("id").alias("o_custkey"), F.lit(3e6).alias("o_totalprice"), F.lit("1-URGENT").alias("o_orderpriority"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(S.L, "train_trees", lambda rows, *_: given.append(rows))
    _, rows, _ = S.trained(Tables(spark, str(tmp_path)))
    assert rows.count() == n and rows.filter("is_test").count() == n // 5
    sizes = [r["count"] for r in given[0].groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n * 4 // 5 and max(sizes) < n / 3
