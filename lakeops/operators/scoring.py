"""Batch scoring: features, balanced training, boosted trees, confidence."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.ordered import ordered_scan
from lakeops.session import scratch_dir
from lakeops.sources.files import list_files


def categories(df: DataFrame, column: str) -> list[str]:
    """Values of a category column, sorted. Each becomes a feature column, so they come to the driver; a caller who knows them passes them."""
    return [r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).toLocalIterator()]


def category_rows(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The same in rows, for any number of values: (key, feature) for each category a row has."""
    names = F.array(*[F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}_"), F.col(c).cast("string"))) for c in columns])
    return df.select(key, F.explode(F.filter(names, lambda x: x.isNotNull())).alias("feature"))


def one_hot(df: DataFrame, column: str, values: Sequence[str], guaranteed: Sequence[str] = ()) -> list[Column]:
    """0/1 column per value, named <column>_<value>; guaranteed values are there even if unseen."""
    wanted = sorted(set(values) | set(guaranteed))
    return [F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in wanted]


def finite(column: Column) -> Column:
    value = column.cast("double")
    return F.when((value != math.inf) & (value != -math.inf) & ~F.isnan(value), value)


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean and unit (population) deviation; infinite counts as missing and stays NULL.

    Means and deviations are one row of a global aggregate.
    """
    exprs = []
    for c in columns:
        exprs += [F.avg(finite(F.col(c))).alias(f"m_{c}"), F.stddev_pop(finite(F.col(c))).alias(f"s_{c}")]
    row = df.agg(*exprs).first()
    return scale(df, columns, {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns})


def scale(df: DataFrame, columns: Sequence[str], moments: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    for c in columns:
        mean, dev = moments[c]
        value = finite(F.col(c)) - F.lit(mean)
        df = df.withColumn(c, value / F.lit(dev) if dev else value)
    return df


def binary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.coalesce(F.col(c).cast("int"), F.lit(0)))
    return df


def feature_matrix(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], flags: Sequence[str],
    guaranteed: dict[str, Sequence[str]] | None = None, keep: Sequence[str] = (), known: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Kept columns plus all feature columns in alphabetical order. ``known`` categories are not looked up in the data."""
    hot: list[Column] = []
    names: list[str] = []
    for c in categorical:
        found = known[c] if known and c in known else categories(df, c)
        values = sorted(set(found) | set((guaranteed or {}).get(c, ())))
        names += [f"{c}_{v}" for v in values]
        hot += one_hot(df, c, values)
    wide = standardize(binary(df, flags), numeric).select(*keep, *numeric, *flags, *hot)
    return wide.select(*keep, *[F.col(f"`{n}`") for n in sorted([*names, *numeric, *flags])])


def sparse_features(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], flags: Sequence[str]) -> PipelineModel:
    """A fitted pipeline that adds ``features``, a sparse vector, for any number of categories.

    Categories are indexed by Spark ML, values unseen in the fit and NULL by an index of their own, and one-hot encoded; the wide form has a column per category and is
    for few of them. Numbers are used as they are, NULL as 0: standardize them first.
    """
    filled = SQLTransformer(statement="select *, " + ", ".join(f"coalesce(cast(`{c}` as double), 0.0) as `_x_{c}`" for c in (*numeric, *flags)) + " from __THIS__")
    index = StringIndexer(inputCols=list(categorical), outputCols=[f"_i_{c}" for c in categorical], handleInvalid="keep", stringOrderType="alphabetAsc")
    hot = OneHotEncoder(inputCols=[f"_i_{c}" for c in categorical], outputCols=[f"_h_{c}" for c in categorical], handleInvalid="keep", dropLast=True)
    parts = VectorAssembler(inputCols=[*[f"_h_{c}" for c in categorical], *[f"_x_{c}" for c in (*numeric, *flags)]], outputCol="features")
    return Pipeline(stages=[filled, index, hot, parts]).fit(df)


def align_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the training columns: missing ones are 0, others are dropped."""
    have = set(df.columns)
    return df.select(*keep, *[(F.coalesce(F.col(f"`{n}`"), F.lit(0)) if n in have else F.lit(0)).alias(n) for n in names])


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42, name: str = "is_test") -> DataFrame:
    """Mark the given share of every class for testing, the same rows on every run.

    Rows of a class are ranked by a hash of their key; the rank is computed over slices of the hash, so
    a class with most of the rows is not one task.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    ranked = ordered_scan(
        hashed, [label], ["_hash"], F.substring("_hash", 1, 4), row_number="_rank", total="_count"
    )
    return ranked.withColumn(name, F.col("_rank") <= F.round(F.col("_count") * test_share)).drop("_hash", "_rank", "_count")


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives, positives and the weight of a positive."""
    counts = df.agg(F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives"))
    return counts.withColumn("positive_weight", F.try_divide("negatives", "positives"))


def even_parts(rows: DataFrame, fewest: int = 20_000, most: int = 200_000) -> int:
    """Into how many even parts to deal rows that are passed over many times: one for each core while parts have ``fewest`` rows, more when they would have over ``most``.

    A split by classes leaves the rows in a task per class, and a model is trained by as many tasks as its rows have parts.
    """
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    return max(1, min(n // fewest, cores * math.ceil(n / (most * cores))))


def train_trees(
    train: DataFrame, features: Sequence[str], label: str, rounds: int = 100, depth: int = 7, rate: float = 0.3,
    seed: int = 42, min_rows: int = 3, row_share: float = 0.8, feature_share: str = "0.8",
) -> PipelineModel:
    """Boosted trees with positives weighted by the class ratio; missing numbers become 0, the mean."""
    weight = class_weight(train, label).first()["positive_weight"] or 1.0
    rows = train.fillna(0, list(features)).withColumn("_weight", F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(1.0))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    trees = GBTClassifier(
        featuresCol="features", labelCol=label, weightCol="_weight", maxIter=rounds, maxDepth=depth, stepSize=rate,
        seed=seed, minInstancesPerNode=min_rows, subsamplingRate=row_share, featureSubsetStrategy=feature_share,
        checkpointInterval=10 if train.sparkSession.sparkContext.getCheckpointDir() else -1,
    )
    model = trees.fit(assembler.transform(rows))
    return PipelineModel(stages=[assembler, model])


def score(model: PipelineModel, rows: DataFrame, features: Sequence[str], name: str = "probability") -> DataFrame:
    scored = model.transform(rows.fillna(0, list(features)))
    kept = [c for c in scored.columns if c not in ("features", "rawPrediction", "probability", "prediction")]
    return scored.select(*[f"`{c}`" for c in kept], "features", vector_to_array("probability")[1].alias(name))


def auc(scored: DataFrame, label: str, probability: str = "probability") -> DataFrame:
    """One row with the exact area under the ROC curve: the share of (positive, negative) pairs in the right order, ties half.

    Rows are counted per distinct score before the shuffle; negatives below a score are summed in slices of the scores.
    """
    positive = F.count_if(F.col(label) == 1).alias("_p")
    counts = scored.filter(F.col(probability).isNotNull()).groupBy(F.lit(0).alias("_all"), F.col(probability).alias("_s")).agg(positive, F.count_if(F.col(label) == 0).alias("_n"))
    below = ordered_scan(counts, ["_all"], ["_s"], F.floor(F.col("_s") * 1000), before={"_below": "_n"})
    pairs = F.sum(F.col("_p") * (F.col("_below") + F.col("_n") / 2))
    return below.agg(F.try_divide(pairs, F.sum("_p") * F.sum("_n")).alias("auc"))


def feature_importance(model: PipelineModel, spark: SparkSession, features: Sequence[str], top: int = 20) -> DataFrame:
    trees: GBTClassificationModel = model.stages[-1]
    pairs = sorted(zip(features, trees.featureImportances.toArray().tolist()), key=lambda p: (-p[1], p[0]))[:top]
    return spark.createDataFrame([(r + 1, f, i) for r, (f, i) in enumerate(pairs)], "rank int, feature string, importance double")


def leaf_values(model: PipelineModel, spark: SparkSession) -> list[list[float]]:
    """The value of every leaf of every tree, from left to right, which is how Spark ML numbers leaves.

    Read from the model as it is saved, where a tree's nodes are numbered from the root, left before right: as many numbers as the model has leaves.
    """
    path = scratch_dir(spark, "trees")
    model.stages[-1].write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").filter("leftChild < 0")
    out: list[list[float]] = [[] for _ in range(model.stages[-1].getNumTrees)]
    for r in nodes.select("treeID", "id", "prediction").orderBy("treeID", "id").collect():
        out[r["treeID"]].append(r["prediction"])
    return out


def tree_margins(model: PipelineModel, scored: DataFrame, name: str = "margins") -> DataFrame:
    """Add the weighted value of each tree for each row, an array: Spark ML finds the leaves, a lookup their values."""
    gbt: GBTClassificationModel = model.stages[-1].copy()
    for setter in (gbt.setRawPredictionCol, gbt.setProbabilityCol, gbt.setPredictionCol):
        setter("")
    leaves = gbt.setLeafCol("_leaves").transform(scored).withColumn("_leaves", vector_to_array("_leaves"))
    weighted = [[w * v for v in values] for w, values in zip(gbt.treeWeights, leaf_values(model, scored.sparkSession), strict=True)]
    table = F.from_json(F.lit(json.dumps(weighted)), "array<array<double>>")  # a constant of the plan
    return leaves.withColumn(name, F.transform("_leaves", lambda leaf, tree: F.get(F.get(table, tree), leaf.cast("int")))).drop("_leaves")


def ensemble_spread(model: PipelineModel, scored: DataFrame, samples: int = 50, seed: int = 42, name: str = "spread") -> DataFrame:
    """Deviation of the probability over random half-ensembles.

    A half-ensemble is the mean margin of half of the trees, drawn once; all of it is built-in array functions on the rows' margins.
    """
    trees = model.stages[-1].getNumTrees
    pick, half = np.random.default_rng(seed), max(1, trees // 2)
    drawn = [sorted(int(t) for t in pick.choice(trees, size=half, replace=False)) for _ in range(samples)]
    halves = F.from_json(F.lit(json.dumps(drawn)), "array<array<int>>")
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)

    def odds_of(margins: Column) -> Column:
        mean = lambda own: F.aggregate(own, F.lit(0.0), lambda acc, tree: acc + F.get(margins, tree)) / half
        return F.transform(halves, lambda own: 1 / (1 + F.exp(-mean(own))))

    def deviation(odds: Column) -> Column:
        return _once(total(odds) / samples, lambda mean: F.sqrt(F.aggregate(odds, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)) / samples))

    rows = tree_margins(model, scored, "_margins")
    return rows.withColumn(name, _once(F.col("_margins"), lambda margins: _once(odds_of(margins), deviation))).drop("_margins")


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often body's lambdas use it: a column of its own would be merged back into them."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def exact_percentile(df: DataFrame, column: str, share: float) -> DataFrame:
    """One row: linearly interpolated percentile of numbers. They are counted per value, and the counts summed in slices of the values."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.lit(0).alias("_all"), F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ranked = ordered_scan(counts, ["_all"], ["v"], F.floor(F.col("v") * 1000), running={"upto": "n"}, sums={"total": "n"})
    ranked = ranked.withColumn("position", (F.col("total") - 1) * F.lit(share))
    at = lambda index: F.min(F.when(F.col("upto") > index, F.col("v")))
    low, high = F.floor("position"), F.ceil("position")
    picked = ranked.agg(at(low).alias("lo"), at(high).alias("hi"), F.max(F.col("position") - low).alias("part"))
    return picked.select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("percentile"))


def confidence(scored: DataFrame, probability: str = "probability", spread: str = "spread", name: str = "confidence") -> DataFrame:
    """0.7 x distance from even odds + 0.3 x agreement of the half-ensembles.

    The 95th percentile of the spread is one number; it is read once so that scoring does not depend on
    a join with everything.
    """
    p95 = exact_percentile(scored, spread, 0.95).first()
    limit = p95["percentile"] if p95 and p95["percentile"] else None
    agreement = F.lit(1.0) if limit is None else F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col(spread) / limit))
    decision = 2 * F.abs(F.col(probability) - 0.5)
    return scored.withColumn(name, 0.7 * decision + 0.3 * agreement)


def save_model(model: PipelineModel, root: str, stamp: str) -> str:
    """Save under a sortable stamp."""
    path = f"{root}/{stamp}"
    model.write().overwrite().save(path)
    return path


def latest_model(spark: SparkSession, root: str) -> PipelineModel:
    """The model with the greatest stamp."""
    marker = root.rstrip("/").split("/")[-1]
    stamps = {f.split(f"/{marker}/", 1)[1].split("/")[0] for f in list_files(spark, root)}
    if not stamps:
        raise FileNotFoundError(f"no model under {root}")
    return PipelineModel.load(f"{root}/{max(stamps)}")
