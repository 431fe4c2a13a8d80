import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.operators import cdc as C
from lakeops.operators import scoring as L
from lakeops.session import materialize, scratch_dir
from lakeops.sinks import merge as M
from lakeops.sinks import tables as W
from lakeops.sources import files as S
from lakeops.sources import increments as I
from lakeops.streaming import jobs as R


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, v) for v in r])


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert rows(materialize(spark.range(3), "m")) == [(0,), (1,), (2,)]


def test_publish_keeps_the_old_version_readable(spark, tmp_path):
    root = str(tmp_path / "t")
    assert W.read_table(spark, root) is None
    first = W.publish(spark.range(3), root)
    W.publish(W.read_table(spark, root).filter("id > 0"), root)
    assert rows(W.read_table(spark, root)) == [(1,), (2,)]
    assert spark.read.parquet(first).count() == 3


def test_json_arrays_and_error_policy(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n {"id": 1},\n {"id": 2}\n]')
    (tmp_path / "b").write_text('{"id": 3}')
    out = S.read_stage_json(spark, str(tmp_path), "id int", strip_outer_array=True)
    assert rows(out) == [(1,), (2,), (3,)]
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.json").write_text('{"id": 1}\n{broken\n{"id": 2}\n')
    assert rows(S.read_stage_json(spark, str(bad), "id int", on_error="continue")) == [(1,), (2,)]
    with pytest.raises(Exception):
        S.read_stage_json(spark, str(bad), "id int").collect()
    with pytest.raises(ValueError):
        S.read_stage_json(spark, str(bad), "id int", on_error="ignore")


def test_path_columns(spark, tmp_path):
    folder = tmp_path / "2024" / "02" / "03" / "org7"
    folder.mkdir(parents=True)
    (folder / "x.json").write_text('{"id": 1}')
    df = S.read_stage_json(spark, str(tmp_path), "id int")
    out = S.with_path_columns(df, str(tmp_path), {"day": ((1, 2, 3), "date"), "org": (4, "string"), "none": (4, "int")}, "filename")
    assert rows(out) == [(1, date(2024, 2, 3), "org7", None, "2024/02/03/org7/x.json")]


def test_empty_location(spark, tmp_path):
    assert S.read_stage_parquet(spark, str(tmp_path / "none")).count() == 0
    assert S.read_stage_parquet(spark, str(tmp_path / "none"), schema=spark.range(1).schema).columns == ["id"]
    assert S.read_stage_parquet(spark, str(tmp_path)).columns == []


def test_schema_is_merged_over_all_files(spark, tmp_path):
    spark.range(101).repartition(101, "id").write.mode("append").parquet(str(tmp_path))
    spark.range(1).withColumn("more", F.lit("x")).write.mode("append").parquet(str(tmp_path))
    spark.range(3).write.mode("append").json(str(tmp_path))
    out = S.read_stage_parquet(spark, str(tmp_path), pattern="*.parquet")
    assert set(out.columns) == {"id", "more"} and out.count() == 102 and out.filter("more = 'x'").count() == 1


@pytest.mark.parametrize("name", ["a+b (x)", "50%25 off", "d.t/e[1]"])
def test_path_columns_below_odd_folders(spark, tmp_path, name):
    root = tmp_path / name
    (root / "org 1+2").mkdir(parents=True)
    (root / "org 1+2" / "x.json").write_text('{"id": 1}')
    df = spark.read.schema("id int").json([str(root / "org 1+2" / "x.json").replace("[", "\\[").replace("]", "\\]")])
    assert rows(S.with_path_columns(df, str(root), {"org": (1, "string")}, "file")) == [(1, "org 1+2", "org 1+2/x.json")]


def test_partition_keys_stay_text(spark, tmp_path):
    spark.range(2).withColumn("billing_period", F.lit("2024-01")).write.mode("append").partitionBy("billing_period").parquet(str(tmp_path))
    assert dict(S.read_partitioned(spark, str(tmp_path)).dtypes)["billing_period"] == "string"


def test_last_partitions_are_pruned(spark, tmp_path):
    days = spark.range(40).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    days.write.mode("append").partitionBy("day").parquet(str(tmp_path))
    recent = S.last_partitions(spark.read.parquet(str(tmp_path)), "day", F.lit("2024-02-05").cast("date"), 5)
    assert recent.count() == 5
    assert "PartitionFilters: [isnotnull(day" in recent._jdf.queryExecution().executedPlan().toString()


def test_files_load_once(spark, tmp_path):
    source, target, ledger = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    schema = spark.range(1).schema
    spark.range(5).write.mode("append").parquet(source)
    assert S.load_new_files(spark, source, target, ledger, schema)["rows_loaded"] == 5
    assert S.load_new_files(spark, source, target, ledger, schema)["rows_loaded"] == 0
    spark.range(5, 8).write.mode("append").parquet(source)
    assert S.load_new_files(spark, source, target, ledger, schema)["rows_loaded"] == 3
    assert rows(S.read_loaded(spark, target, schema)) == [(i,) for i in range(8)]
    spark.range(8, 138).repartition(130, "id").write.mode("append").parquet(source)
    again = S.load_new_files(spark, source, target, ledger, schema)
    assert again["rows_loaded"] == 130 and again["total_rows"] == 138 and 60 < again["files_loaded"] < len(S.list_files(spark, source))


def test_a_load_does_not_read_its_table(spark, tmp_path):
    """Once files are loaded, their folder in the table is not needed by later runs: it is replaced by one that cannot be read."""
    source, target, ledger = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    schema = spark.range(1).schema
    spark.range(5).write.mode("append").parquet(source)
    S.load_new_files(spark, source, target, ledger, schema)
    for file in (tmp_path / "out/rows/batch=0").glob("part-*"):
        file.write_bytes(b"no parquet")
    spark.range(5, 8).write.mode("append").parquet(source)
    audit = S.load_new_files(spark, source, target, ledger, schema)
    assert audit["rows_loaded"] == 3 and audit["total_rows"] == 8 and audit["files_loaded"] > 0


def test_csv_quoting(spark, tmp_path):
    path = str(tmp_path / "csv")
    W.export_csv(spark.createDataFrame([(1, 'a,"b"', None)], "id int, t string, n string").coalesce(1), path)
    text = next((tmp_path / "csv").glob("part-*.csv")).read_text()
    assert text == 'id,t,n\n1,"a,""b""",\n'


LOG = "id int, v string, op string, ts timestamp_ntz"
KEYS = dict(keys=["id"], ts="ts", op="op")


@pytest.mark.parametrize("compact_every", [1, 2, 8])
def test_change_log_stream_survives_restarts_and_replays(spark, tmp_path, compact_every):
    at = lambda n: datetime(2024, 1, 1) + timedelta(minutes=n)
    source, ledger = (str(tmp_path / n) for n in ("in", "ledger"))
    schema = spark.createDataFrame([], LOG).schema
    state = R.FoldedLog(str(tmp_path / "state"), schema, **KEYS, buckets=4, compact_every=compact_every)
    batches = [
        [(1, "a", "I", at(0)), (2, "b", "I", at(0)), (None, "n", "I", at(0))], [(1, "z", "D", at(5)), (None, "m", "U", at(3))],
        [(1, "late", "U", at(2)), (3, "c", "I", at(1)), (None, "late", "U", at(1))],
    ]
    for batch in batches:
        spark.createDataFrame(batch, LOG).coalesce(1).write.mode("append").parquet(source)
        R.fold_change_log(S.stream_files(spark, source, schema), state, ledger)
        assert len(state.pending(spark)) < compact_every
    expected = [(2, "b"), (3, "c"), (None, "m")]
    by_id = lambda df: sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0]))
    assert by_id(R.current_state(spark, state)) == expected
    # A second reader that starts over writes the same batches again.
    R.fold_change_log(S.stream_files(spark, source, schema, per_batch=1), state, str(tmp_path / "again"))
    assert by_id(R.current_state(spark, state)) == expected
    R.compact_state(spark, state, 99)
    assert state.pending(spark) == {} and by_id(R.current_state(spark, state)) == expected
    R.compact_state(spark, state, 99)
    assert by_id(R.current_state(spark, state)) == expected
    assert R.current_state(spark, R.FoldedLog(str(tmp_path / "nothing"), schema, **KEYS)).count() == 0


def test_lag_buckets(spark):
    base = datetime(2024, 1, 1)
    hours = [0, 5.99, 6, 12, 24, 48, 168]
    df = spark.createDataFrame([(base, base + timedelta(hours=h)) for h in hours], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(R.lag_bucket(F.col("a"), F.col("b"))).collect()] == ["<6h", "<6h", "6-12h", "12-24h", "24-48h", "2-7d", ">7d"]


def test_metrics_of_more_than_a_hundred_batches(spark, tmp_path):
    source, target, metrics, ledger = (str(tmp_path / n) for n in ("in", "out", "metrics", "ledger"))
    for start in (0, 60):
        spark.range(start, start + 60).repartition(60, "id").write.mode("append").parquet(source)
    one = S.stream_files(spark, source, spark.range(1).schema, per_batch=1)
    R.append_with_metrics(one, target, metrics, ledger)
    R.append_with_metrics(one, target, metrics, ledger)
    told = R.refresh_metrics(spark, metrics).collect()
    assert len(told) > 60 and sum(r["rows"] for r in told) == 120 and {r["action"] for r in told} <= {"INCREMENTAL", "NO_DATA"}
    assert spark.read.parquet(target).count() == 120
    assert R.refresh_metrics(spark, str(tmp_path / "none")).count() == 0


def test_open_sessions_complete_the_closed_ones(spark):
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    views = spark.createDataFrame([("a", at(0)), ("a", at(20)), ("a", at(45)), ("b", at(0)), (None, at(50)), ("c", at(60)), ("c", at(10))], "v string, ts timestamp")
    mark = F.lit(at(60)).cast("timestamp")
    left = R.open_sessions(views, "v", "ts", mark)
    assert rows(left.select("v", "views")) == [("a", 3), ("c", 1), (None, 1)]
    closed = spark.createDataFrame([("c", at(10), at(10), 1), ("b", at(0), at(0), 1)], "v string, session_start_at timestamp, session_end_at timestamp, views long")
    assert rows(R.open_sessions(views, "v", "ts", mark, closed=closed).select("v", "views")) == [("a", 3), ("c", 1), (None, 1)]


def test_ties_at_the_cap_are_not_lost(spark):
    source = spark.createDataFrame([(i, i // 4) for i in range(12)], "id int, ts int")
    for slices in (None, F.floor(F.col("ts") / 2)):
        got, mark = [], None
        while True:
            batch = [r["id"] for r in I.next_rows(source, "ts", mark, 6, slice_by=slices).collect()]
            if not batch:
                break
            got.append(sorted(batch))
            mark = max(i // 4 for i in batch)
        assert sum(got, []) == list(range(12)) and len(got) == 2
    assert I.next_rows(source, "ts", None, 100).count() == 12


def test_a_key_twice_in_a_merge_source_is_an_error(spark):
    target, twice = spark.createDataFrame([(1, "a")], "id int, v string"), spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string")
    for merge in (M.upsert, M.insert_missing):
        with pytest.raises(Exception, match="twice in the source"):
            merge(target.filter("id > 5"), twice, ["id"]).collect()
    nulls = spark.createDataFrame([(None, "b"), (None, "c")], "id int, v string")
    assert M.upsert(target, nulls, ["id"]).count() == 3


def test_both_folds_keep_null_times_and_keys(spark):
    at = datetime(2024, 1, 1)
    log = spark.createDataFrame([(1, "a", "I", None), (2, "b", "I", at), (2, "c", "U", None), (None, "d", "I", at), (3, "e", "D", at)], LOG)
    one, two = (rows(f(log, **KEYS)) for f in (C.cdc_current, C.cdc_current_two_phase))
    assert one == two and len(one) == 3



def test_percentile_and_auc_are_exact(spark):
    import numpy as np

    values = np.random.default_rng(1).random(2501)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = L.exact_percentile(df, "v", 0.95).first()["percentile"]
    assert got == pytest.approx(np.percentile(values, 95), abs=1e-12)
    scored = spark.createDataFrame([(float(v), int((i * 7919) % 5 < 2 + v)) for i, v in enumerate(values)] + [(0.5, 0), (0.5, 1)], "probability double, won int")
    pairs = [(r["probability"], r["won"]) for r in scored.collect()]
    good, bad = [s for s, w in pairs if w], [s for s, w in pairs if not w]
    plain = sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))
    assert L.auc(scored, "won").first()["auc"] == pytest.approx(plain, abs=1e-12)


def test_split_is_exact_and_stable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("won"))
    one = L.stratified_split(df, "id", "won").groupBy("won", "is_test").count()
    assert rows(one) == [(0, False, 720), (0, True, 180), (1, False, 80), (1, True, 20)]
    again = L.stratified_split(df.repartition(7), "id", "won")
    assert again.exceptAll(L.stratified_split(df, "id", "won")).count() == 0


def test_features(spark):
    df = spark.createDataFrame([(1, "a", 1.0, True), (2, "b", 3.0, None), (3, None, float("inf"), False)], "id int, c string, x double, f boolean")
    out = L.feature_matrix(df, ["c"], ["x"], ["f"], {"c": ["never"]}, keep=["id"])
    assert out.columns == ["id", "c_a", "c_b", "c_never", "f", "x"]
    assert rows(out) == [(1, 1, 0, 0, 1, -1.0), (2, 0, 1, 0, 0, 1.0), (3, 0, 0, 0, 0, None)]
    assert rows(L.align_features(out, ["x", "c_gone", "c_a"], ["id"])) == [(1, -1.0, 0, 1), (2, 1.0, 0, 0), (3, 0.0, 0, 0)]


def test_model_learns_and_confidence_is_bounded(spark, tmp_path):
    df = spark.range(600).select("id", (F.pmod(F.hash("id"), F.lit(100)) / 100).alias("x"), (F.pmod(F.hash(F.col("id") + 9), F.lit(7))).cast("double").alias("noise"))
    df = materialize(df.withColumn("won", (F.col("x") > 0.7).cast("int")), "train")
    model = L.train_trees(df, ["x", "noise"], "won", rounds=5, depth=3)
    scored = L.score(model, df, ["x", "noise"])
    assert L.auc(scored, "won").first()["auc"] > 0.95
    spread = L.ensemble_spread(model, scored)
    out = L.confidence(spread)
    low, high, negative = out.agg(F.min("confidence"), F.max("confidence"), F.count_if(F.col("spread") < 0)).first()
    assert 0 <= low <= high <= 1 and negative == 0
    assert L.feature_importance(model, spark, ["x", "noise"]).first()["feature"] == "x"
    L.save_model(model, str(tmp_path / "models"), "2024-01-01")
    latest = L.latest_model(spark, str(tmp_path / "models"))
    assert L.score(latest, df, ["x", "noise"]).exceptAll(scored).count() == 0
