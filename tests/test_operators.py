import math
import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators import aggregates as A
from lakeops.operators import cdc as C
from lakeops.operators import contracts as K
from lakeops.operators import joins as J
from lakeops.operators import nested as V
from lakeops.operators import snapshots as H
from lakeops.plans import checks as Q
from lakeops.plans.semantic import classify, metric_query, model_from_dict
from lakeops.sinks import merge as M
from lakeops.sources import increments as I


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


LOG = "id int, seq int, v string, op string, ts timestamp_ntz"
AT = lambda n: datetime(2024, 1, 1) + timedelta(minutes=n)
LOG_ROWS = [
    (1, 0, "new", "I", AT(0)), (1, 1, "changed", "U", AT(1)),  # insert, update
    (2, 0, "gone", "I", AT(0)), (2, 1, "gone", "D", AT(1)),  # insert, delete
    (3, 0, "x", "D", AT(0)), (3, 1, "back", "I", AT(1)),  # delete, insert
    (4, 0, "tied", "D", AT(5)), (4, 1, "kept", "U", AT(5)),  # a tie with a delete
    (5, 0, None, "D", AT(2)),  # only a delete
    (6, 0, "late", "U", AT(0)), (6, 1, "dead", "D", AT(3)),  # a delete with a late older update
]
CURRENT = [(1, 1, "changed"), (3, 1, "back"), (4, 1, "kept")]
KEYS = dict(keys=["id"], ts="ts", op="op", tie=["seq"])


def test_change_log_folds(spark):
    log = spark.createDataFrame(LOG_ROWS, LOG)
    assert rows(C.cdc_current(log, **KEYS)) == CURRENT
    assert rows(C.cdc_current_two_phase(log, **KEYS)) == CURRENT


def test_incremental_folds_do_not_depend_on_order(spark):
    for seed in range(3):
        order = LOG_ROWS[:]
        random.Random(seed).shuffle(order)
        parts = [spark.createDataFrame(order[i::3], LOG) for i in range(3)]
        state = C.cdc_latest(parts[0], **KEYS)
        for part in (parts[1], parts[2], parts[1]):
            state = C.cdc_apply(state, part, **KEYS)
        assert rows(C.visible(state, "ts", "op")) == CURRENT


def test_fold_with_baseline(spark):
    log = spark.createDataFrame(LOG_ROWS, LOG)
    baseline = spark.createDataFrame([(5, 9, "old"), (7, 9, "old")], "id int, seq int, v string")
    assert (7, 9, "old") in rows(C.cdc_current(log, **KEYS, baseline=baseline))
    assert 5 not in [r[0] for r in rows(C.cdc_current(log, **KEYS, baseline=baseline))]


def test_key_columns():
    assert C.key_columns("jobs") == ["id"]
    assert C.key_columns("checklist", {"checklist": ["organization_id", "entry_key"]}) == ["organization_id", "entry_key"]


def test_payload_update_protects_what_is_there(spark):
    schema = "id int, state string, payload string"
    target = spark.createDataFrame([(1, "a", '{"x":1}'), (2, "a", "{}"), (3, "a", None), (4, "a", '{"x":4}')], schema)
    source = spark.createDataFrame([(1, "b", "{}"), (2, "b", '{"y":2}'), (3, "b", None), (5, "b", "{}")], schema)
    assert rows(M.update_payload(target, source, ["id"], "payload")) == [
        (1, "a", '{"x":1}'), (2, "a", '{"y":2}'), (3, "a", None), (4, "a", '{"x":4}'), (5, "b", "{}"),
    ]


def test_merges_and_replacements(spark):
    t = spark.createDataFrame([(1, date(2024, 1, 1), "t"), (2, date(2024, 1, 2), "t"), (3, date(2024, 1, 3), "t"), (4, None, "t")], "id int, d date, v string")
    s = spark.createDataFrame([(2, date(2024, 1, 2), "s"), (9, date(2024, 1, 2), "s")], t.schema)
    empty = s.limit(0)
    d = lambda text: F.lit(text).cast("date")
    assert rows(M.upsert(t, s, ["id"]), "id", "v") == [(1, "t"), (2, "s"), (3, "t"), (4, "t"), (9, "s")]
    assert rows(M.insert_missing(t, s, ["id"]), "id", "v") == [(1, "t"), (2, "t"), (3, "t"), (4, "t"), (9, "s")]
    assert rows(M.replace_keys(t, s, ["d"]), "id", "v") == [(1, "t"), (2, "s"), (3, "t"), (4, "t"), (9, "s")]
    half = M.replace_range(t, s, "d", d("2024-01-01"), d("2024-01-03"))
    assert rows(half, "id") == [(2,), (3,), (4,), (9,)]
    assert rows(M.replace_range(t, s, "d", d("2024-01-01"), d("2024-01-03"), inclusive=True), "id") == [(2,), (4,), (9,)]
    assert rows(M.replace_range(None, s, "d", d("2024-01-01"), d("2024-01-03")), "id") == [(2,), (9,)]
    assert M.replace_all(t, empty).count() == 0
    assert M.replace_if_any(t, empty).count() == 4 and M.replace_if_any(t, s).count() == 2


def test_lookback_must_fit_the_target_window(spark):
    df = spark.createDataFrame([(1, AT(0))], "id int, ts timestamp_ntz")
    with pytest.raises(ValueError):
        I.reread_lookback(df, df, ["id"], "ts", F.lit("2024-01-02").cast("timestamp_ntz"), hours=200, days=7)


def test_snapshot_by_check(spark):
    schema = "id int, a string, b int"
    first = spark.createDataFrame([(1, "same", 1), (2, "old", 1), (3, None, 1), (4, "gone", 1)], schema)
    second = spark.createDataFrame([(1, "same", 9), (2, "new", 1), (3, "set", 1), (5, "added", 1)], schema)
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    history = H.start_history(first, at("2024-01-01"))
    for _ in range(2):  # a second run of the day changes nothing
        history = H.snapshot_by_check(history, second, ["id"], ["a"], F.lit("2024-01-02"), hard_deletes=True)
    one, two = datetime(2024, 1, 1), datetime(2024, 1, 2)
    assert rows(history, "id", "a", "valid_from", "valid_to", "is_current") == sorted([
        (1, "same", one, None, True), (2, "old", one, two, False), (2, "new", two, None, True), (3, None, one, two, False),
        (3, "set", two, None, True), (4, "gone", one, two, False), (5, "added", two, None, True),
    ], key=str)
    assert rows(H.as_of(history, at("2024-01-01")), "id") == [(1,), (2,), (3,), (4,)]
    assert rows(H.as_of(history, at("2024-01-02")), "id") == [(1,), (2,), (3,), (5,)]


def contract_inputs(spark):
    d = date.fromisoformat
    contracts = spark.createDataFrame(
        [(n, 1, 7, d(f"{2023 + n}-01-01"), d(f"{2023 + n}-12-31")) for n in (1, 2, 3)],
        "contract_id int, opportunity_id int, account_id int, contract_start_date date, contract_end_date date",
    )
    opportunities = spark.createDataFrame(
        [(1, 7, "New Business", True, True, d("2024-01-01")), (2, 7, "Upsell", True, True, d("2024-08-15")), (3, 7, "Upsell", True, False, d("2024-08-15")),
         (4, 7, "Renewal", True, True, d("2023-01-01"))],
        "opportunity_id int, account_id int, opportunity_type string, is_closed boolean, is_won boolean, close_date date",
    )
    quotes = spark.createDataFrame([(11, 1, True), (12, 1, False), (21, 2, True), (31, 3, True), (41, 4, True)], "quote_id int, opportunity_id int, is_syncing boolean")
    lines = spark.createDataFrame(
        [(11, 1, "Base Credits", 1_000_000), (11, 2, "Base Credits", 1_000_000), (11, 3, "Base Credits", 1_000_000), (12, 1, "Base Credits", 5),
         (21, 1, "Base Credits", 500_000), (31, 1, "Base Credits", 7), (41, 1, "Base Credits", 9), (11, 1, "Support", 3)],
        "quote_id int, term int, product_name string, quantity bigint",
    )
    return contracts, opportunities, quotes, lines


def test_contract_example(spark):
    """Three one-year terms of a million credits; an upsell in the first belongs to the last."""
    out = K.contract_credits(*contract_inputs(spark))
    columns = ("contract_id", "quoted_contracted_credits", "upsell_credits", "sum_prior_terms_upsell_credits", "sum_future_terms_upsell_credits", "sum_previous_terms_quoted_contracted_credits")
    assert rows(out, *columns) == [
        (1, 1_000_000, 0, 0, 500_000, 0), (2, 1_000_000, 0, 0, 500_000, 1_000_000), (3, 1_000_000, 500_000, 0, 0, 2_000_000),
    ]
    assert rows(K.account_capacity(out, 7), "contract_id", "total_credits") == [(1, 1_000_000), (2, 1_000_000), (3, 1_500_000)]


def at(minutes):
    return datetime(2024, 1, 1) + timedelta(minutes=minutes)


def test_range_join_equals_brute_force(spark):
    rng = random.Random(1)
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    points = [(rng.choice(["hot", "hot", "a", None]), i, day(rng.randrange(400))) for i in range(150)]
    periods = [(rng.choice(["hot", "hot", "a"]), i, day(s), day(s + rng.randrange(-5, 150))) for i, s in enumerate(rng.choices(range(400), k=80))]
    got = J.range_join(
        spark.createDataFrame(points, "k string, p int, at date"), spark.createDataFrame(periods, "k string, q int, s date, e date"), ["k"], "at", "s", "e"
    )
    expected = sorted((p, q) for k, p, at in points for k2, q, s, e in periods if k == k2 and s <= at <= e)
    assert sorted(rows(got, "p", "q")) == expected


def test_dyadic_bins_cover_exactly(spark):
    rng = random.Random(4)
    ranges = [(a, a + rng.choice([0, 1, 2, 3, 7, 8, 100, 1000])) for a in [*range(-9, 9), *(rng.randrange(-10_000, 10_000) for _ in range(80))]]
    df = spark.createDataFrame(ranges, "a long, b long").select("a", "b", J.dyadic_bins(F.col("a"), F.col("b")).alias("bins"))
    for r in df.collect():
        covered = sorted(x for b in r["bins"] for x in range(b["bin"] << b["level"], (b["bin"] + 1) << b["level"]))
        assert covered == list(range(r["a"], r["b"] + 1))
        assert len(r["bins"]) <= 2 * math.log2(r["b"] - r["a"] + 2)


@pytest.mark.parametrize("unit, hot_rows", [("second", 1_000_000), ("hour", 20), ("week", 5)])
def test_range_join_of_times(spark, unit, hot_rows):
    """Times to the microsecond, also before 1970; long and short periods; bounds that meet; hot keys salted."""
    rng = random.Random(2)
    moment = lambda: datetime(1969, 6, 1) + timedelta(microseconds=rng.randrange(400 * 86_400) * 1_000_000 + rng.randrange(3))
    points = [(rng.choice(["hot", "hot", "a", None]), i, moment()) for i in range(300)] + [("a", 999, None)]
    starts = [*(p[2] for p in points[:30]), *(moment() for _ in range(40))]
    periods = [(rng.choice(["hot", "a", None]), i, s, s + timedelta(seconds=rng.choice([0, 1, 3_600, 86_400, 20_000_000]))) for i, s in enumerate(starts)] + [("a", 999, None, None)]
    got = J.range_join(
        spark.createDataFrame(points, "k string, p int, at timestamp_ntz"), spark.createDataFrame(periods, "k string, q int, s timestamp_ntz, e timestamp_ntz"),
        ["k"], "at", "s", "e", unit, hot_rows=hot_rows, salts=4,
    )
    expected = sorted((p, q) for k, p, at in points for k2, q, s, e in periods if k and at and s and k == k2 and s <= at <= e)
    assert sorted(rows(got, "p", "q")) == expected and len(expected) > 100


@pytest.mark.parametrize("pairs_a_row", [0, 5, 64])
def test_range_join_by_key_and_by_bins(spark, pairs_a_row):
    """All keys by bins, only the one with many points and periods, and none; keys of two columns, NULLs in each, repeated rows."""
    rng = random.Random(5)
    moment = lambda: datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(90 * 1440))
    key = lambda: ("hot", 1) if rng.random() < 0.5 else (rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None]))
    points = [(*key(), i // 2, moment()) for i in range(200)]
    starts = [moment() for _ in range(60)]
    periods = [(*key(), i // 2, s, s + timedelta(hours=rng.randrange(-5, 900))) for i, s in enumerate(starts)]
    got = J.range_join(
        spark.createDataFrame(points, "k string, l int, p int, at timestamp_ntz"), spark.createDataFrame(periods, "k string, l int, q int, s timestamp_ntz, e timestamp_ntz"),
        ["k", "l"], "at", "s", "e", "hour", pairs_a_row=pairs_a_row,
    )
    expected = sorted((p, q) for k, l, p, at in points for k2, l2, q, s, e in periods if k and l and (k, l) == (k2, l2) and s <= at <= e)
    assert sorted(rows(got, "p", "q")) == expected and len(expected) > 100


def test_range_join_of_few_rows_a_key_lays_out_no_period(spark, capsys):
    """Ten rows a key: their pairs grow with the rows, so no period is copied over its bins before the shuffle."""
    moment = F.timestamp_seconds(F.col("id") * 3_600).cast("timestamp_ntz")
    points = spark.range(1_000).select((F.col("id") % 100).alias("k"), moment.alias("at"))
    periods = spark.range(1_000).select((F.col("id") % 100).alias("k"), moment.alias("s"), F.timestamp_seconds(F.col("id") * 3_600 + 999_999).cast("timestamp_ntz").alias("e"))
    J.range_join(points, periods, ["k"], "at", "s", "e").explain()
    assert "Generate" not in capsys.readouterr().out


@pytest.mark.parametrize("unit, hot_rows", [("day", 1_000_000), ("hour", 20)])
def test_range_totals_equal_the_pairs(spark, unit, hot_rows):
    """Bounds that meet points, empty and reversed periods, NULLs, repeated points and periods; also with keys in slices."""
    rng = random.Random(6)
    moment = lambda: datetime(1969, 12, 1) + timedelta(hours=rng.randrange(60 * 24), microseconds=rng.randrange(2))
    points = [(rng.choice(["hot", "hot", "a", None]), i // 2, moment()) for i in range(300)] + [("a", 999, None)]
    starts = [*(p[2] for p in points[:40]), *(moment() for _ in range(40))]
    periods = [(rng.choice(["hot", "a", None]), rng.choice([None, i]), s, s + timedelta(seconds=rng.choice([-1, 0, 1, 3_600, 86_400, 2_000_000]))) for i, s in enumerate(starts)]
    periods += [*periods[:10], ("a", 5, None, None), ("hot", 7, moment(), None)]
    got = J.range_totals(
        spark.createDataFrame(points, "k string, p int, at timestamp_ntz"), spark.createDataFrame(periods, "k string, q int, s timestamp_ntz, e timestamp_ntz"),
        ["k"], "at", "s", "e", count="n", sums={"total": "q"}, unit=unit, hot_rows=hot_rows,
    )
    expected = []
    for k, p, at in points:
        of = [q for k2, q, s, e in periods if k and at and s and e and k == k2 and s <= at <= e]
        if of:
            known = [q for q in of if q is not None]
            expected.append((k, p, at, len(of), sum(known) if known else None))
    assert rows(got, "k", "p", "at", "n", "total") == sorted(expected, key=str) and len(expected) > 100


def test_range_totals_make_no_row_of_a_pair(spark):
    """A thousand periods hold each of a thousand points: two rows a period and one a point are put in order, no pair is."""
    moment = F.timestamp_seconds("id").cast("timestamp_ntz")
    points = spark.range(1_000).select(F.lit(1).alias("k"), moment.alias("at"))
    periods = spark.range(1_000).select(F.lit(1).alias("k"), F.timestamp_seconds(-F.col("id")).cast("timestamp_ntz").alias("s"), F.timestamp_seconds(F.col("id") + 2_000).cast("timestamp_ntz").alias("e"))
    got = J.range_totals(points, periods, ["k"], "at", "s", "e", count="n")
    assert got.agg(F.count(F.lit(1)), F.min("n"), F.max("n")).first() == (1_000, 1_000, 1_000)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(400).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).alias("k"), F.col("id").alias("i"))
    right = spark.range(40).select((F.col("id") % 20).alias("k"), F.col("id").alias("r"))
    assert rows(J.salted_join(left, right, ["k"], F.col("i"), how, hot_rows=20, salts=4)) == rows(left.join(right, "k", how))


def test_patterns(spark):
    ips = spark.createDataFrame([("10.1.2.3",), ("10.2.0.0",), ("9.9.9.9",), (None,)], "ip string")
    patterns = spark.createDataFrame([("10.1.%",), ("9%",), ("%.0",), (None,)], "p string")
    assert rows(J.matches_any_pattern(ips, "ip", patterns, "p", "bot")) == [("10.1.2.3", True), ("10.2.0.0", True), ("9.9.9.9", True), (None, None)]
    assert rows(J.matches_any_pattern(ips, "ip", patterns.limit(0), "p", "bot"), "bot") == [(False,)] * 4


def test_internal_users(spark):
    mails = spark.createDataFrame([("a@own.org",), ("b@else.org",), ("friend@else.org",), ("none",), (None,)], "email string")
    domains = spark.createDataFrame([("own.org",)], "domain string")
    out = J.is_internal_user(mails, "email", domains, "domain", ["friend@else.org"])
    assert dict(rows(out)) == {"a@own.org": True, "b@else.org": False, "friend@else.org": True, "none": False, None: False}


@pytest.mark.parametrize("body, expected", [('{"a":1}', '{"a":1}'), (None, "{}"), ("", "{}"), ("{broken", "{}"), ("[1]", "{}"), ("7", "{}"), ("null", "{}"), ("{}", "{}")])
def test_object_or_empty(spark, body, expected):
    df = spark.createDataFrame([(body,)], "b string")
    assert rows(df.select(V.object_or_empty(F.col("b")))) == [(expected,)]


def test_one_or_many(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, '[{"a":2}, 7, "x", {"a":3}]'), (3, "[]"), (4, None), (5, " {\"a\":5}")], "id int, b string")
    out = df.select("id", F.explode(V.one_or_many(F.col("b"), "a int")).alias("x")).select("id", "x.a")
    assert rows(out) == [(1, 1), (2, 2), (2, 3), (5, 5)]


def test_a_parent_has_one_row(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    children = spark.range(120_000).select(F.lit(1).alias("parent"), F.col("id").cast("int").alias("child")).union(spark.createDataFrame([(2, 7)], "parent int, child int"))
    out = {r["id"]: r["n"] for r in V.attach_children(parents, children, "id", "parent", [], "child").select("id", F.size("children").alias("n")).collect()}
    assert out == {1: 120_000, 2: 1, 3: 0}
    assert V.child_rows(parents, children, "id", "parent", ["child"]).count() == 120_002


def test_many_patterns(spark):
    patterns = spark.range(1500).select(F.concat(F.lit("%"), F.col("id").cast("string"), F.lit("x_")).alias("p"))
    texts = spark.createDataFrame([("a77xb",), ("1499xq",), ("1500x",), (None,)], "t string")
    assert rows(J.matches_any_pattern(texts, "t", patterns, "p", "hit")) == [("1499xq", True), ("1500x", False), ("a77xb", True), (None, None)]


def test_pattern_index_equals_like(spark):
    """All kinds of patterns: anchored at one side, with literals of one to many characters, escapes, wildcards only, empty, none that matches."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("ab%_\\é𝔘c") for _ in range(n))
    texts = ["", "a", "%", "_", "a_b", "line\nbreak", *(word(rng.randrange(1, 9)) for _ in range(150))]
    quote = lambda w: re.sub(r"([%_\\])", r"\\\1", w)
    patterns = [["%zz%"], [""], ["______"], ["________%_"], ["%a\nb%"], ["%e\nb%"], ["é%"], [r"%\_b"], ["_", "%b_b_"]]
    patterns += [["".join(rng.choice(["%", "_", "", ""]) + quote(word(rng.randrange(0, 4))) for _ in range(rng.randrange(1, 4))) + rng.choice(["%", ""])] for _ in range(120)]

    def like(text: str, pattern: str) -> bool:
        tokens = re.findall(r"(?s)\\.|.", pattern)
        return re.fullmatch("(?s)" + "".join(".*" if t == "%" else "." if t == "_" else re.escape(t[-1]) for t in tokens), text) is not None

    all_texts = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    for some in patterns:
        listed = spark.createDataFrame([(p,) for p in some], "p string")
        got = J.matching_texts(all_texts, "t", listed, "p") if some in patterns[:12] else None
        if got is not None:
            assert {r[0] for r in got.collect()} == {t for t in texts if any(like(t, p) for p in some)}, some
    every = spark.createDataFrame([(p,) for some in patterns[9:] for p in some if "%" in p[1:] or "_" in p], "p string")
    listed = [r[0] for r in every.collect()]
    wanted = {t for t in texts if any(like(t, p) for p in listed)}
    got = J.matching_texts(all_texts, "t", every, "p")
    assert {r[0] for r in got.collect()} == wanted
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_unit_members(spark):
    held = spark.createDataFrame([(1, "7;9"), (1, "7"), (2, None), (3, "8;;x")], "k int, ids string")
    units = spark.range(600).select("id", F.concat(F.lit("u"), "id").alias("name"))
    assert rows(A.unit_members(held, ["k"], "ids", units, "id", "name")) == [(1, "u7"), (1, "u9"), (3, "u8")]


def test_unknown_document_layout_fails(spark):
    docs = spark.createDataFrame([("k", '{"other": 1}')], "key string, body string")
    with pytest.raises(Exception, match="unknown document layout"):
        V.repository_documents(docs, spark.createDataFrame([], "uri string, body string")).collect()


def test_transcript_duplicates(spark):
    df = spark.createDataFrame(
        [("c", 1, [("s", 0, "hi"), ("s", 0, "hi"), ("s", 5, "hi")]), ("d", 2, [("s", 0, "hi")])],
        "conversation string, row int, sentences array<struct<speaker_id:string,start_ms:int,text:string>>",
    )
    fields = {n: F.col(f"e.{n}") for n in ("speaker_id", "start_ms", "text")}
    assert rows(Q.nested_duplicates(df, ["conversation", "row"], "sentences", fields)) == [("c", 1, "s", 0, "hi", 2)]


def test_flakiness_shows_examples_only_when_useful(spark):
    jobs = spark.createDataFrame(
        [(1, "a", "passed", "script"), (2, "a", "failed", "script"), (3, "b", "failed", "script"), (4, None, "passed", "script"), (5, "a", "passed", "wait")],
        "n int, name string, state string, type string",
    )
    out = A.flakiness(jobs, F.col("name"), "state", F.col("n").cast("string"), ["n"], F.col("type") == "script")
    assert rows(out) == [("a", 1, 1, "2", "1", True), ("b", 0, 1, "3", None, False), ("unknown", 1, 0, None, None, False)]


MODEL = {"semantic_model": [{"name": "arr", "datasets": [{"name": "arr", "primary_key": ["contract_id", "month"], "fields": [
    {"name": n, "expression": {"dialects": [{"expression": n}]}, **({"dimension": {"is_time": True}} if n == "month" else {})}
    for n in ("contract_id", "account_id", "month", "is_active", "arr", "ar")]}],
    "metrics": [
        {"name": "total_arr", "expression": {"dialects": [{"expression": "SUM(arr.arr)"}]}, "ai_context": {"synonyms": ["Total Revenue"]}},
        {"name": "accounts", "expression": {"dialects": [{"expression": "COUNT(DISTINCT arr.account_id)"}]}},
    ]}]}


def test_semantic_model(spark):
    model = model_from_dict(MODEL)
    assert {n for n, kind in classify(model).items() if kind == "fact"} == {"arr"}
    df = spark.createDataFrame([(1, 1, "m1", True, 5), (2, 1, "m1", False, 7), (3, 2, "m2", True, 1)], "contract_id int, account_id int, month string, is_active boolean, arr int")
    assert rows(metric_query(df, model, ["total revenue", "accounts"], ["month"])) == [("m1", 12, 1), ("m2", 1, 1)]
    with pytest.raises(ValueError):
        metric_query(df, model, ["total_arr"], ["arr"])
    with pytest.raises(KeyError):
        metric_query(df, model, ["profit"])


def test_checks_on_empty_and_stale_tables(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 12))], "id int, ts timestamp_ntz")
    now = F.lit("2024-01-01 20:59:00").cast("timestamp_ntz")
    assert Q.stale(df, "ts", now, "9 hours").count() == 0
    assert Q.stale(df, "ts", now, "8 hours").count() == 1
    assert Q.stale(df.limit(0), "ts", now, "9 hours").count() == 1
    assert Q.empty_table(df).count() == 0 and Q.empty_table(df.limit(0)).count() == 1
    assert Q.count_mismatch(df, df).count() == 0
    assert Q.schema_violations(df, df.schema).count() == 0
    assert Q.schema_violations(df, StructType.fromDDL("id bigint")).count() == 2
    for bad in ("a b", "1a", "x;drop", ""):
        with pytest.raises(ValueError):
            Q.safe_identifier(bad)
    out = Q.run_checks([Q.Check("unique", Q.not_unique(df, ["id"])), Q.Check("filled", Q.empty_table(df.limit(0)), "WARN")])
    assert rows(out) == [("filled", False, "WARN", 1), ("unique", True, "ERROR", 0)]


def test_idle_objects_need_a_matching_name(spark):
    objects = spark.createDataFrame([("db_CLONE_1", date(2024, 1, 1), date(2024, 1, 2)), ("db_CLONE_2", date(2024, 1, 1), date(2024, 3, 1)), ("prod", date(2020, 1, 1), date(2020, 1, 1))], "name string, created date, altered date")
    uses = spark.createDataFrame([("db_CLONE_1", datetime(2024, 2, 20))], "name string, used timestamp_ntz")
    out = A.idle_objects(objects, uses, "name", "created", "altered", "used", F.lit("2024-03-10").cast("date"), r"^\w+_CLONE_\d+$")
    assert rows(out) == [("db_CLONE_1", date(2024, 2, 20), 19)]


def test_first_and_more_keeps_every_group(spark):
    df = spark.createDataFrame([(k, v) for k in ("a", None) for v in "dcba"] + [("b", "x")], "k string, v string")
    out = A.first_and_more(df, "k", "v", 2)
    assert rows(out) == [("a", "a, b, and 2 more", 4), ("b", "x", 1), (None, "a, b, and 2 more", 4)]


def test_series_merge_fills_gaps(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "k int, a int")
    b = spark.createDataFrame([(2, 7), (3, 8)], "k int, b int")
    assert rows(J.merge_series({"a": a, "b": b}, "k")) == [(1, 5, 0), (2, 6, 7), (3, 0, 8)]


def test_rules_run_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.createDataFrame([(1, "1_a", 5, at(0)), (2, "9_a", None, at(1)), (3, None, -1, None), (4, "x", 7, at(2))], "id int, plan string, n int, ts timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path)
    rules = [
        Q.accepted_rule("known", "plan", ["1", "2"]), Q.matching_rule("pattern", "plan", "^[0-9]_", F.col("id") == 4), Q.required_rule("required", "n", F.col("id") < 3, "WARN"),
        Q.numeric_rule("number", "plan"), Q.Rule("positive", F.col("n") < 0), Q.filled_rule("filled"), Q.share_rule("share", F.col("n") > 4, 10, 49.0),
        Q.fresh_rule("fresh", "ts", F.lit(at(100)).cast("timestamp_ntz"), "1 hour"), Q.fresh_rule("fresh enough", "ts", F.lit(at(100)).cast("timestamp_ntz"), "2 hours"),
        Q.share_rule("few", F.col("n") > 4, 1, 100.0),
    ]
    out = Q.run_rules(df, rules, "id", samples=8)
    got = {r["check_name"]: (r["passed"], r["failing_rows"], r["sample_keys"]) for r in out.collect()}
    assert got == {
        "known": (False, 2, ["2", "4"]), "pattern": (False, 1, ["3"]), "required": (False, 1, ["2"]), "number": (False, 4, ["1", "2", "3", "4"]), "positive": (False, 1, ["3"]),
        "filled": (True, 0, []), "share": (False, 1, []), "fresh": (False, 1, []), "fresh enough": (True, 0, []), "few": (False, 1, []),
    }
    both = Q.run_checks([Q.Check("unique", Q.not_unique(df, ["id"]))], [(df, rules)])
    assert both.count() == 11 and both.columns == ["check_name", "passed", "severity", "failing_rows"]
    assert Q.run_rules(df, rules, "id")._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    none = {r["check_name"]: r["passed"] for r in Q.run_rules(df.limit(0), rules).collect()}
    assert none == {r.name: r.name not in ("filled", "fresh", "fresh enough") for r in rules}


def test_contract_of_records(spark):
    records = ['{"a":1,"b":"x"}', '{"a":"1","b":null}', '{"a":2.5,"c":[1],"d":{"e":1},"f":true}', "[1]", "{broken", None, "7"]
    contract = spark.createDataFrame([("a", "integer"), ("b", "text"), ("c", "array"), ("z", "text")], "column_name string, expected string")
    got = Q.contract_violations(spark.createDataFrame([(r,) for r in records], "r string"), "r", contract)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("a", "integer", "text", 1), ("a", "integer", "decimal", 1), ("d", None, "object", 1), ("f", None, "boolean", 1),
        ("a", "integer", None, 4), ("b", "text", None, 6), ("c", "array", None, 6), ("z", "text", None, 7),
    ], key=str)


def test_shuffle_partitions_are_joined_to_a_size_that_a_task_can_sort(spark):
    """A larger size is lowered, a smaller one stays."""
    from lakeops.session import ADVISORY, configure

    before = spark.conf.get(ADVISORY)
    try:
        for given, kept in (("64MB", "16777216b"), ("67108864b", "16777216b"), ("8m", "8m"), ("1g", "16777216b")):
            spark.conf.set(ADVISORY, given)
            assert configure(spark).conf.get(ADVISORY) == kept
    finally:
        spark.conf.set(ADVISORY, before)
