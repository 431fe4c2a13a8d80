"""Scoring: customers as opportunities, won when they spend much."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import scoring as L
from lakeops.queries.registry import query
from lakeops.session import materialize

LIMIT = 2_500_000


def customers(t):
    spent = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("urgent"),
    )
    joined = t.customer.join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
        F.coalesce("n_orders", F.lit(0)).cast("double").alias("n_orders"), F.col("urgent"),
        (F.coalesce("cents", F.lit(0)) > LIMIT * 100).cast("int").alias("won"),
    )


CUSTOMERS_SQL = f"""
spent as (select o_custkey, count(*) as n_orders, sum(cast(round(o_totalprice * 100) as bigint)) as cents, max(case when o_orderpriority = '1-URGENT' then 1 end) as urgent from orders group by 1),
base as (select c_custkey, c_mktsegment as segment, c_acctbal as balance, cast(coalesce(n_orders, 0) as double) as n_orders, urgent,
  case when coalesce(cents, 0) > {LIMIT} * 100 then 1 else 0 end as won from customer left join spent on c_custkey = o_custkey)"""


def matrix(t):
    rows = customers(t)
    return L.feature_matrix(rows, ["segment"], ["balance", "n_orders"], ["urgent"], {"segment": ["OTHER"]}, keep=["c_custkey", "won"])


def feature_names(df):
    return [c for c in df.columns if c not in ("c_custkey", "won")]


@query("l1_feature_matrix", f"""with {CUSTOMERS_SQL}
select c_custkey, (segment = 'AUTOMOBILE')::int as "segment_AUTOMOBILE", (segment = 'BUILDING')::int as "segment_BUILDING", (segment = 'FURNITURE')::int as "segment_FURNITURE", (segment = 'HOUSEHOLD')::int as "segment_HOUSEHOLD",
  (segment = 'MACHINERY')::int as "segment_MACHINERY", 0 as "segment_OTHER", coalesce(urgent, 0) as urgent from base""")
def _(t):
    rows = matrix(t)
    return rows.select("c_custkey", *[c for c in rows.columns if c.startswith("segment_")], "urgent")


@query("l2_standardized", f"""with {CUSTOMERS_SQL}
select c_custkey, round((balance - avg(balance) over ()) / stddev_pop(balance) over (), 5) as balance, round((n_orders - avg(n_orders) over ()) / stddev_pop(n_orders) over (), 5) as n_orders from base""")
def _(t):
    rows = L.standardize(customers(t), ["balance", "n_orders"])
    return rows.select("c_custkey", F.round("balance", 5).alias("balance"), F.round("n_orders", 5).alias("n_orders"))


@query("l3_class_weight", f"""with {CUSTOMERS_SQL}
select count(*) filter (won = 0) as negatives, count(*) filter (won = 1) as positives, round(count(*) filter (won = 0) / count(*) filter (won = 1), 6) as positive_weight from base""")
def _(t):
    return L.class_weight(customers(t), "won").withColumn("positive_weight", F.round("positive_weight", 6))


@query("l4_stratified_split", f"""with {CUSTOMERS_SQL}
select c_custkey, row_number() over (partition by won order by md5('42:' || c_custkey)) <= round(count(*) over (partition by won) * 0.2) as is_test from base""")
def _(t):
    return L.stratified_split(customers(t), "c_custkey", "won").select("c_custkey", "is_test")


@query("l9_aligned_features", f"with {CUSTOMERS_SQL} select c_custkey, 0 as gone, n_orders, coalesce(urgent, 0) as urgent from base")
def _(t):
    return L.align_features(customers(t), ["gone", "n_orders", "urgent"], ["c_custkey"])


#: The full model of a run and table, which several queries use: {(application, table folder): (model, features path, names)}.
_TRAINED: dict = {}


def trained(t):
    """The model with all its rounds, the feature rows and the feature names. A session trains it once per folder of tables."""
    key = (t.spark.sparkContext.applicationId, t.root)
    if key not in _TRAINED:
        # Training passes over its input many times, so the features are written once, in as many parts as tasks have work for.
        path = t.scratch("features")
        L.stratified_split(matrix(t), "c_custkey", "won").write.parquet(path)
        rows = t.spark.read.parquet(path)
        parts = L.even_parts(rows)
        if parts > 1:
            path = t.scratch("features")
            rows.repartition(parts, "c_custkey").write.parquet(path)
            rows = t.spark.read.parquet(path)
        names = [n for n in feature_names(rows) if n != "is_test"]
        _TRAINED[key] = (L.train_trees(rows.filter("not is_test"), names, "won"), path, names)
    model, path, names = _TRAINED[key]
    return model, t.spark.read.parquet(path), names


@query("l5_scored_customers")
def _(t):
    """Held-out customers, scored by boosted trees."""
    model, rows, names = trained(t)
    return L.score(model, rows.filter("is_test"), names).select("c_custkey", "won", F.round("probability", 6).alias("probability"))


@query("l7_confidence")
def _(t):
    """How sure the model is of each customer, from half-ensembles."""
    model, rows, names = trained(t)
    spread = L.ensemble_spread(model, L.score(model, rows, names))
    # Read twice, for the percentile and for the result.
    spread = materialize(spread.select("c_custkey", "won", "probability", "spread"), "spread")
    return L.confidence(spread).select("c_custkey", "won", F.round("probability", 6).alias("probability"), F.round("confidence", 6).alias("confidence"))


@query("l6_auc")
def _(t):
    model, rows, names = trained(t)
    value = L.auc(L.score(model, rows.filter("is_test"), names), "won")
    return value.select(F.round("auc", 4).alias("auc"))


@query("l6_exact_auc", f"""with {CUSTOMERS_SQL}, ranked as (select won, row_number() over (order by n_orders) - 1 as r, n_orders from base),
mid as (select won, avg(r) over (partition by n_orders) + 1 as rank from ranked)
select round((sum(rank) filter (won = 1) - count(*) filter (won = 1) * (count(*) filter (won = 1) + 1) / 2) / (count(*) filter (won = 1) * count(*) filter (won = 0)), 9) as auc from mid""")
def _(t):
    """The number of orders as the score, so that the value does not depend on a learner."""
    return L.auc(customers(t), "won", "n_orders").select(F.round("auc", 9).alias("auc"))


@query("l7_exact_confidence", f"""with {CUSTOMERS_SQL}, s as (select c_custkey, (balance + 1000) / 11000 as probability, abs(balance) / 100000 as spread from base)
select c_custkey, round(0.7 * 2 * abs(probability - 0.5) + 0.3 * greatest(0, least(1, 1 - spread / (select quantile_cont(spread, 0.95) from s))), 6) as confidence from s""")
def _(t):
    """A score and a spread made from the balance, so that the formula and its percentile can be compared."""
    scored = customers(t).select("c_custkey", ((F.col("balance") + 1000) / 11000).alias("probability"), (F.abs("balance") / 100000).alias("spread"))
    return L.confidence(scored).select("c_custkey", F.round("confidence", 6).alias("confidence"))


@query("l8_feature_importance")
def _(t):
    model, rows, names = trained(t)
    return L.feature_importance(model, t.spark, names)


@query("l10_saved_model_predictions")
def _(t):
    """Save, load the latest, score the open customers, append with the run's time."""
    from lakeops.sinks.merge import append_run

    model, rows, names = trained(t)
    root = t.scratch("models")
    L.save_model(model, root, "2024-01-01")
    L.save_model(model, root, "2024-01-02")
    latest = L.latest_model(t.spark, root)
    scored = L.score(latest, L.align_features(rows, names, ["c_custkey"]), names)
    return append_run(None, scored.select("c_custkey", F.round("probability", 6).alias("probability")), F.lit("2024-01-02").cast("timestamp_ntz"))
