"""Stored state: key buckets, change-log folds and split histories."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.operators import cdc as C
from lakeops.operators import snapshots as H
from lakeops.sinks import merge as M
from lakeops.sinks import tables as W
from lakeops.sinks.buckets import KeyBuckets

LOG = "id int, v string, op string, ts timestamp_ntz, n int"
RULE = dict(ts="ts", op="op", tie=["n"])


def at(minutes: int) -> datetime:
    return datetime(2024, 1, 1) + timedelta(minutes=minutes)


def by_text(df) -> list:
    return sorted(map(tuple, df.collect()), key=str)


def files(root) -> dict:
    return {os.path.relpath(os.path.join(d, f), root): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def log_rows(seed: int, n: int, keys: int) -> list[tuple]:
    state, out = seed, []
    for k in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        key = (state >> 8) % keys
        out.append((None if key == 3 else key, f"v{k}", "IUUD"[(state >> 16) % 4], None if state % 29 == 0 else at((state >> 4) % 50), k))
    return out


def test_bucketed_fold_equals_one_fold_of_all_batches(spark, tmp_path):
    everything = log_rows(5, 400, 40)
    schema = spark.createDataFrame([], LOG).schema
    table = KeyBuckets(spark, str(tmp_path / "state"), schema, ["id"], 8)
    for version in range(8):
        C.cdc_merge(table, spark.createDataFrame(everything[version * 50 : version * 50 + 50], LOG), version, **RULE)
    one = C.cdc_current(spark.createDataFrame(everything, LOG), ["id"], **RULE)
    assert by_text(C.visible(table.read(), "ts", "op")) == by_text(one) and table.read().filter("id is null").count() == 1
    before = by_text(table.read())
    C.cdc_merge(table, spark.createDataFrame(everything[350:], LOG), 7, **RULE)  # the last batch once more
    C.cdc_merge(table, spark.createDataFrame(everything[:50], LOG), 8, **RULE)  # and the first, late
    assert by_text(table.read()) == before


def test_in_memory_fold_keeps_one_row_of_a_null_key(spark):
    state = spark.createDataFrame([(None, "a", "I", at(0), 1), (1, "x", "I", at(0), 1)], LOG)
    for batch in ([(None, "b", "U", at(1), 2)], [(None, "b", "U", at(1), 2)], [(None, "late", "U", at(0), 0)]):
        state = C.cdc_apply(state, spark.createDataFrame(batch, LOG), ["id"], **RULE)
    assert by_text(state.select("id", "v")) == [(1, "x"), (None, "b")]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root = str(tmp_path / "state")
    table = KeyBuckets(spark, root, spark.createDataFrame([], LOG).schema, ["id"], 8)
    C.cdc_merge(table, spark.createDataFrame([(k, "a", "I", at(0), 0) for k in range(100)], LOG), 0, **RULE)
    first = files(root)
    batch = spark.createDataFrame([(5, "b", "U", at(1), 0), (None, "b", "U", at(1), 0)], LOG)
    touched = table.touched(batch)
    C.cdc_merge(table, batch, 1, **RULE)
    now = files(root)
    assert {f: now.get(f) for f in first} == first and len(touched) <= 2
    assert {f.split("/")[1] for f in now if f.startswith("v=1/")} == {f"_bucket={b}" for b in touched}
    read = {f.split("_bucket=")[0].rstrip("/").rsplit("/", 1)[-1] for b, f in table.current().items() if b in touched}
    assert read == {"v=1"}
    C.cdc_merge(table, spark.createDataFrame([(5, "c", "U", at(2), 0)], LOG), 2, **RULE)
    kept = files(root)
    assert not any(f.startswith("v=0/") and f.split("/")[1] in {f"_bucket={b}" for b in touched} for f in kept)  # superseded by run 1, gone after run 2
    assert table.read().count() == 101


def test_a_run_that_did_not_commit_is_not_read(spark, tmp_path):
    table = KeyBuckets(spark, str(tmp_path / "state"), spark.createDataFrame([], LOG).schema, ["id"], 4)
    C.cdc_merge(table, spark.createDataFrame([(1, "a", "I", at(0), 0), (2, "a", "I", at(0), 0)], LOG), 0, **RULE)
    C.cdc_merge(table, spark.createDataFrame([(1, "b", "U", at(1), 0)], LOG), 1, **RULE)
    os.remove(tmp_path / "state/v=1/_COMMITTED")
    assert by_text(table.read().select("id", "v")) == [(1, "a"), (2, "a")]
    C.cdc_merge(table, spark.createDataFrame([(2, "c", "U", at(2), 0)], LOG), 1, **RULE)
    assert by_text(table.read().select("id", "v")) == [(1, "a"), (2, "c")]


def test_text_times(spark):
    rows = [(1, "new", "U", "2024-01-01T10:00:00+00:00"), (1, "old", "U", "2024-01-01 11:30:00+02:00"), (2, "gone", "D", "2024-01-01 09:00:00.5"), (2, "was", "I", "2024-01-01 09:00")]
    log = spark.createDataFrame(rows, "id int, v string, op string, at string")
    for fold in (C.cdc_current, C.cdc_current_two_phase):
        assert by_text(fold(log, ["id"], "at", "op", ts_type="timestamp").select("id", "v")) == [(1, "new")]
    state = C.cdc_apply(log.filter("v = 'new'"), log.filter("v = 'old'"), ["id"], "at", "op", ts_type="timestamp")
    assert by_text(state.select("id", "v")) == [(1, "new")]


DAY = "id int, v string, updated_at date"


def histories(spark, tmp_path, keys=("id",)):
    schema = H.start_history(spark.createDataFrame([], DAY), F.lit(None).cast("timestamp_ntz")).schema
    return H.SplitHistory(KeyBuckets(spark, str(tmp_path / "current"), schema, list(keys), 8), str(tmp_path / "closed")), spark.createDataFrame([], schema)


@pytest.mark.parametrize("closes", [False, True])
def test_split_history_equals_whole_history(spark, tmp_path, closes):
    split, whole = histories(spark, tmp_path)
    days = [
        [(k, "a", None) for k in [*range(50), None]], [(k, "b" if k and k % 10 == 0 else "a", None) for k in [*range(45), None, 99]],
        [(k, "b" if k and k % 10 == 0 else "a", None) for k in [*range(45), None, 99]], [(7, None, None), (8, "c", None), (None, "z", None)],
    ]
    for version, day in enumerate(days):
        batch, when = spark.createDataFrame(day, DAY), F.lit(datetime(2024, 1, version + 1)).cast("timestamp_ntz")
        whole = H.snapshot_by_check(whole, batch, ["id"], ["v"], when, hard_deletes=closes)
        split.run(batch, version, H.differs(["v"]), when, when if closes else None)
        assert by_text(split.read()) == by_text(whole)
        assert split.read().filter("id is null and is_current").count() == 1
    split.run(batch, version, H.differs(["v"]), when, when if closes else None)  # the same run again
    split.run(batch, version + 1, H.differs(["v"]), when, when if closes else None)  # and its batch as a new one
    assert by_text(split.read()) == by_text(whole)


def test_a_run_of_the_history_touches_few_files(spark, tmp_path):
    split, _ = histories(spark, tmp_path)
    when = lambda d: F.lit(datetime(2024, 1, d)).cast("timestamp_ntz")
    split.run(spark.createDataFrame([(k, "a", None) for k in range(100)], DAY), 0, H.differs(["v"]), when(1))
    split.run(spark.createDataFrame([(5, "b", None)], DAY), 1, H.differs(["v"]), when(2))
    current, closed = files(tmp_path / "current"), files(tmp_path / "closed")
    split.run(spark.createDataFrame([(k, "b" if k == 5 else "c" if k == 6 else "a", None) for k in range(100)], DAY), 2, H.differs(["v"]), when(3), when(3))
    now = files(tmp_path / "current")
    new = {f for f in now if f not in current}
    assert len({f.split("/")[1] for f in new}) == 1 and len(now) - len(new) >= 7
    assert closed.items() <= files(tmp_path / "closed").items()
    assert split.read().count() == 102 and split.read().filter("is_current").count() == 100


def test_timestamp_history_with_null_keys(spark, tmp_path):
    split, whole = histories(spark, tmp_path)
    day = lambda d: datetime(2024, 1, d).date()
    for version, batch in enumerate([[(None, "a", day(1)), (1, "a", day(1))], [(None, "a", day(1)), (1, "b", day(2))], [(None, "c", day(3)), (1, "b", day(1))]]):
        df = spark.createDataFrame(batch, DAY)
        whole = H.snapshot_by_timestamp(whole, df, ["id"], "updated_at")
        split.run(df, version, H.grew("updated_at"), F.col("updated_at"))
    assert by_text(whole) == by_text(split.read())
    assert by_text(whole.select("id", "v", "is_current")) == [(1, "a", False), (1, "b", True), (None, "a", False), (None, "c", True)]


def test_every_merge_rejects_a_key_twice_in_the_source(spark):
    target = spark.createDataFrame([(1, "a"), (None, "n")], "id int, payload string")
    twice = spark.createDataFrame([(1, "b"), (1, "c"), (2, "d"), (2, "e")], "id int, payload string")
    fine = spark.createDataFrame([(1, "b"), (None, "x"), (None, "y")], "id int, payload string")
    for merge in (lambda s: M.upsert(target, s, ["id"]), lambda s: M.insert_missing(target, s, ["id"]), lambda s: M.update_payload(target, s, ["id"], "payload")):
        with pytest.raises(Exception, match="twice in the source"):
            merge(twice).collect()
        assert merge(fine).filter("id is null").count() == 3
    plan = M.unique_source(fine, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("merge", [M.upsert, M.insert_missing, M.replace_keys])
def test_merges_do_not_shuffle_a_bucketed_target(spark, tmp_path, merge):
    root, keys = str(tmp_path / "bucketed"), ["id", "part"]
    target = spark.range(200).select(F.col("id"), (F.col("id") % 3).cast("string").alias("part"), F.lit("old").alias("v"))
    source = spark.range(150, 260).select(F.col("id"), (F.col("id") % 3).cast("string").alias("part"), F.lit("new").alias("v"))
    assert W.read_bucketed(spark, root, target.schema, keys, 4) is None
    W.publish_bucketed(target, root, keys, 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge(W.read_bucketed(spark, root, target.schema, keys, 4), source, keys)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("SortMergeJoin") :]
        sides = [s for s in join.split("\n") if "Exchange" in s or "FileScan" in s or "Range (" in s]
        near = [i for i, s in enumerate(sides) if "FileScan" in s and "Bucketed: true" in s]
        assert near and all(i == 0 or "FileScan" in sides[i - 1] or "Range (" in sides[i - 1] for i in near), plan
        assert by_text(merged) == by_text(merge(target, source, keys))
        W.publish_bucketed(merged, root, keys, 4)
        spark.sql(f"drop table if exists lakeops_{os.path.basename(W.current_path(spark, root))}")  # another session does not know the version
        assert by_text(W.read_bucketed(spark, root, target.schema, keys, 4)) == by_text(merge(target, source, keys))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
