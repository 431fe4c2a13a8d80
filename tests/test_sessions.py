import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.operators.attribution import SiteHosts, page_attribution_category
from lakeops.operators.sessions import merge_sessions, sessionize
from lakeops.operators.ordered import ordered_scan

START = datetime(2024, 1, 1)


def brute_sessions(rows, gap=1800):
    """(visitor, ts, id) rows to {id: (view, session, page, total)}"""
    out, by_visitor = {}, {}
    for visitor, ts, key in rows:
        by_visitor.setdefault(visitor, []).append((ts, key))
    for views in by_visitor.values():
        views.sort()
        session, previous, members = 0, None, {}
        for n, (ts, key) in enumerate(views, 1):
            whole = lambda t: int(t.replace(microsecond=0).timestamp())
            if previous is None or whole(ts) - whole(previous) > gap:
                session += 1
            members.setdefault(session, []).append(key)
            out[key] = [n, session, len(members[session]), 0]
            previous = ts
        for keys in members.values():
            for key in keys:
                out[key][3] = len(keys)
    return {k: tuple(v) for k, v in out.items()}


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "visitor string, ts timestamp_ntz, id bigint")
    out = sessionize(df, "visitor", "ts", tie=["id"], **options).collect()
    return {r["id"]: r for r in out}


def numbers(r):
    return r["page_view_number"], r["session_number"], r["page_number_in_session"], r["total_pages_in_session"]


def test_gaps_around_the_threshold(spark):
    times = [0, 1799, 1799 + 1800, 1799 + 1800 + 1801]
    got = run(spark, [("a", START + timedelta(seconds=s), i) for i, s in enumerate(times)])
    assert [got[i]["session_number"] for i in range(4)] == [1, 1, 1, 2]
    # 1800.2 seconds that cross 1801 boundaries count as 1801.
    late = run(spark, [("a", START + timedelta(seconds=0.9), 0), ("a", START + timedelta(seconds=1801.1), 1)])
    assert late[1]["session_number"] == 2


@pytest.mark.parametrize("slicing", [{}, {"slice_seconds": 60}, {"slice_seconds": 7}, {"hot_rows": 3}])
def test_hot_visitor_equals_brute_force(spark, slicing):
    import random

    rng = random.Random(5)
    rows, at = [], START
    for i in range(900):  # one visitor with most views, among them ties and long breaks
        at += timedelta(seconds=rng.choice([0, 1, 40, 700, 1799.5, 1800, 1800.4, 1801, 9000]))
        rows.append(("hot", at, i))
    rows += [(f"v{i % 40}", START + timedelta(seconds=rng.random() * 90000), 1000 + i) for i in range(300)]
    got = run(spark, rows, **slicing)
    assert {k: numbers(r) for k, r in got.items()} == brute_sessions(rows)


def test_unknown_visitors(spark):
    rows = [(None, START + timedelta(hours=i), i) for i in range(4)] + [("", START, 9)]
    got = run(spark, rows)
    assert all(got[i]["session_id"] is None and got[i]["session_start_at"] is None for i in range(4))
    assert [numbers(got[i]) for i in range(4)] == [(1, 1, 1, 4), (2, 2, 2, 4), (3, 3, 3, 4), (4, 4, 4, 4)]
    assert got[9]["session_id"] is not None
    by_ip = run(spark, rows, by_ip=True)
    assert by_ip[1]["session_id"] is not None and numbers(by_ip[1]) == (2, 2, 1, 1)


def test_views_without_a_time_are_sessions_of_their_own(spark):
    got = run(spark, [("a", START, 0), ("a", None, 2), ("a", None, 1), ("a", START + timedelta(seconds=5), 3)], hot_rows=1)
    assert {k: numbers(r) for k, r in got.items()} == {0: (1, 1, 1, 2), 3: (2, 1, 2, 2), 1: (3, 2, 1, 1), 2: (4, 3, 1, 1)}
    assert len({r["session_id"] for r in got.values()}) == 3


def test_entry_and_domains(spark):
    df = spark.createDataFrame(
        [("a", START, 1, "x", None), ("a", START + timedelta(minutes=20), 2, "y", "late"), ("a", START + timedelta(minutes=45), 3, "x", "later"), ("a", START + timedelta(hours=9), 4, None, "new")],
        "visitor string, ts timestamp_ntz, id bigint, domain string, source string",
    )
    out = {r["id"]: r for r in sessionize(df, "visitor", "ts", tie=["id"], entry={"entry": "source"}, domain="domain").collect()}
    assert [out[i]["entry"] for i in (1, 2, 3, 4)] == [None, None, None, "new"]
    assert out[3]["domains_in_session"] == ["x", "y"] and out[3]["number_domains_in_session"] == 2
    assert out[4]["domains_in_session"] == [] and out[4]["number_domains_in_session"] == 0


def test_domains_of_a_long_session(spark):
    """One visitor without a break over many slices, alternating between sites."""
    df = spark.range(4000).select(
        F.lit("bot").alias("visitor"), (F.lit(START) + F.make_dt_interval(mins=F.col("id").cast("int") * 29)).cast("timestamp_ntz").alias("ts"), "id",
        F.concat(F.lit("site"), (F.col("id") % 3).cast("string")).alias("domain"),
    )
    out = sessionize(df, "visitor", "ts", tie=["id"], domain="domain")
    total, sessions, sites = out.agg(F.count(F.lit(1)), F.max("session_number"), F.collect_set("domains_in_session")).first()
    assert (total, sessions, sites) == (4000, 1, [["site0", "site1", "site2"]])


def category(spark, **values):
    names = (
        "gclid reddit_cid msclkid ttclid linkedin_campaign_id wbraid gbraid dclid fbclid twclid campaign_source campaign_medium campaign_name utm_term referrer_host referrer_medium path"
    ).split()
    row = spark.range(1).select(*[F.lit(values.get(n)).cast("string").alias(n) for n in names])
    hosts = SiteHosts(docs=["docs.site.example"], learning=["courses.site.example"], own=["site.example", "%.cloud.example"], product=["product.example"])
    return row.select(page_attribution_category(hosts).alias("c")).first()["c"]


@pytest.mark.parametrize("expected, values", [
    ("cpc", dict(gbraid="1", campaign_medium="email")), ("cpc", dict(campaign_medium="ppc")),
    ("ai", dict(campaign_source="claude", campaign_medium="zine")), ("ai", dict(campaign_source="claude", referrer_host="x", referrer_medium="ai")),
    ("social", dict(campaign_source="claude", referrer_host="x", referrer_medium="social")), ("newsletter", dict(campaign_medium="rss")),
    ("jobposting", dict(campaign_medium="dynamitejobs-job-post")), ("other-campaign", dict(campaign_medium="zine")), ("social", dict(twclid="1")),
    ("search-brand", dict(referrer_medium="search", referrer_host="x", path="/cloud")), ("search-vs", dict(referrer_medium="search", referrer_host="x", path="/vs-other")),
    ("search-other", dict(referrer_medium="search", referrer_host="x", path="/else")), ("news", dict(referrer_medium="news", referrer_host="x")),
    ("zoom", dict(referrer_host="us.zoom.us")), ("docs", dict(referrer_host="docs.site.example")), ("learning", dict(referrer_host="courses.site.example")),
    ("blog", dict(path="/blog/x")), ("glossary", dict(path="/glossary")), ("events", dict(path="/events/1", referrer_host="y")), ("other-campaign", dict(utm_term="x", path="/")),
    ("own-referrer", dict(referrer_host="a.cloud.example")), ("product-referrer", dict(referrer_host="product.example")), ("other-referrer", dict(referrer_host="z")), ("uncategorized", dict(path="/")),
])
def test_categories(spark, expected, values):
    assert category(spark, **values) == expected


@pytest.mark.parametrize("hot_rows", [None, 0, 60, 5_000_000])
def test_ordered_scan_equals_plain_windows(spark, hot_rows):
    """One key has most rows; NULL keys form a group of their own. All keys sliced, the large ones, none."""
    import random

    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", "", None]), rng.choice([None, *range(50)]), i, rng.choice([None, 1, 2, 5])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, o int, i int, v int")
    got = ordered_scan(
        df, ["k"], ["o", "i"], F.floor(F.col("o") / 7), row_number="rn", total="n", lag={"p": "v"}, first={"f": "i"}, running={"r": "v"},
        before={"b": "v"}, after={"a": "v"}, sums={"s": "v"}, hot_rows=hot_rows,
    ).collect()
    groups = {}
    for k, o, i, v in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2])):
        groups.setdefault(k, []).append((i, v))
    expected = {}
    for members in groups.values():
        values = [v or 0 for _, v in members]
        for n, (i, v) in enumerate(members):
            expected[i] = (n + 1, len(members), members[n - 1][1] if n else None, members[0][0], sum(values[: n + 1]), sum(values[:n]), sum(values[n + 1:]), sum(values))
    assert {r["i"]: (r["rn"], r["n"], r["p"], r["f"], r["r"], r["b"], r["a"], r["s"]) for r in got} == expected


@pytest.mark.parametrize("salts", [1, 7])
def test_merged_parts_are_whole_sessions(spark, salts):
    """A third of the views has no visitor; parts over salts and late parts; gaps of exactly one gap and a second more."""
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    views = [(rng.choice([None, None, "a", "b"]), start + timedelta(seconds=rng.randrange(4 * 86_400))) for _ in range(500)]
    views += [("edge", start + timedelta(seconds=s)) for s in (0, 1_800, 3_601, 5_401, 9_000)]
    parts: dict = {}
    for i, (v, ts) in enumerate(sorted(views, key=lambda x: x[1])):
        held = parts.setdefault((v, i % salts), [])
        if held and (ts - held[-1][1]).total_seconds() <= 1_800:
            held[-1][1:] = [ts, held[-1][2] + 1]
        else:
            held.append([ts, ts, 1])
    listed = [(v, *p) for (v, _), own in parts.items() for p in own]
    got = merge_sessions(spark.createDataFrame(listed, "v string, session_start_at timestamp, session_end_at timestamp, views long"), "v").collect()
    whole: dict = {}
    for v, ts in sorted(views, key=lambda x: x[1]):
        own = whole.setdefault(v, [])
        if own and (ts - own[-1][1]).total_seconds() <= 1_800:
            own[-1][1:] = [ts, own[-1][2] + 1]
        else:
            own.append([ts, ts, 1])
    assert sorted(map(tuple, got), key=str) == sorted(((v, *p) for v, own in whole.items() for p in own), key=str)


def test_untimed_views_in_slices(spark):
    """One slice or many give the same numbers, with a third of the views in the unknown visitor's untimed ones."""
    views = [(i, None if i % 3 else "a", None if i % 2 else START + timedelta(seconds=977 * i)) for i in range(120)]
    df = spark.createDataFrame(views, "i int, v string, ts timestamp_ntz")
    whole, cut = (
        {r["i"]: tuple(r) for r in sessionize(df, "v", "ts", tie=["i"], untimed_slice=by, helpers=True).collect()} for by in (None, F.floor(F.col("i") / 7))
    )
    assert whole == cut and len(whole) == 120
    for visitor in (None, "a"):
        own = sorted((i for i, v, ts in views if v == visitor and ts is None))
        first = whole[own[0]]
        assert [whole[i][df.columns.index("ts") + 1] for i in own] == list(range(first[3], first[3] + len(own)))
        assert [whole[i][4] for i in own] == list(range(first[4], first[4] + len(own)))
