"""Sessions of page views.

Views are cut into slices no longer than the inactivity gap, so a slice can never hold two sessions of
one visitor. All session logic then runs on one row per (visitor, slice): a visitor has at most
(time span / slice) of them, however many views they have. Views meet their slice again in a join on
(visitor, slice), the same partitioning that numbers them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.dates import seconds_between
from lakeops.functions.text import website_domain
from lakeops.operators.attribution import (
    SiteHosts,
    campaign_identifier,
    is_paid_category,
    page_attribution_category,
    paid_platform,
    with_referrer_medium,
)

_VISITOR = ["_visitor", "_unknown"]
NARROW_SECONDS = 60
UNTIMED = 2**62  # first slice of views without a timestamp, after all others


def _sliced(df: DataFrame, visitor: str, ts: str, seconds: int, hot_rows: int | None, untimed_slice: Column | None) -> DataFrame:
    """Views with their visitor, never NULL, and the start second of their slice."""
    untimed = F.lit(UNTIMED) if untimed_slice is None else F.lit(UNTIMED) + F.coalesce(untimed_slice.cast("bigint"), F.lit(0))
    at = F.unix_seconds(F.col(ts).cast("timestamp"))
    start = lambda width: F.floor(at / width) * width
    narrow = min(seconds, NARROW_SECONDS)
    views = df.select(
        "*",
        F.coalesce(F.col(visitor).cast("string"), F.lit("")).alias("_visitor"),
        F.col(visitor).isNull().alias("_unknown"),
        # Views without a visitor are one group however many there are.
        F.coalesce(F.when(F.col(visitor).isNull(), start(narrow)).otherwise(start(seconds)), untimed).alias("_slice"),
    )
    if hot_rows is None:
        return views
    # At most (views / hot_rows) slices are hot, which bounds what is broadcast.
    counted = views.groupBy(*_VISITOR, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    hot = counted.filter(F.col("_n") > hot_rows).select(*_VISITOR, "_slice", F.lit(True).alias("_hot"))
    marked = views.join(F.broadcast(hot), [*_VISITOR, "_slice"], "left")
    return marked.withColumn("_slice", F.when(F.col("_hot") & at.isNotNull(), start(1)).otherwise(F.col("_slice"))).drop("_hot")


def _with_session_domains(slices: DataFrame, by_ip: bool) -> DataFrame:
    """Sorted distinct domains of each slice's session.

    Only a domain's first slice in the session contributes it, so what is collected has the size of the
    result however many slices a session has. The unknown group, whose session never ends, gets no list
    unless it counts as an address: its domains are not laid out at all.
    """
    if not by_ip:
        slices = slices.withColumn("_domains", F.when(~F.col("_unknown"), F.col("_domains")))
    session = Window.partitionBy(*_VISITOR, "session_number")
    rest = [c for c in slices.columns if c != "_domains"]
    each = slices.select(*rest, F.posexplode_outer("_domains").alias("_at", "_domain"))
    nth = F.row_number().over(Window.partitionBy(*_VISITOR, "session_number", "_domain").orderBy("_slice"))
    each = each.withColumn("_new_domain", F.when(nth == 1, F.col("_domain")))
    found = F.sort_array(F.collect_list("_new_domain").over(session))
    return each.withColumn("domains_in_session", found).filter(F.coalesce("_at", F.lit(0)) == 0).select(*rest, "domains_in_session")


def _session_id(by_ip: bool) -> Column:
    label = F.md5(F.concat(F.col("_visitor"), F.col("session_number").cast("string")))
    return label if by_ip else F.when(~F.col("_unknown"), label)


def sessionize(
    df: DataFrame,
    visitor: str,
    ts: str,
    *,
    gap: int = 1800,
    tie: Sequence[str] = (),
    entry: Mapping[str, str] | None = None,
    domain: str | None = None,
    by_ip: bool = False,
    slice_seconds: int | None = None,
    hot_rows: int | None = None,
    untimed_slice: Column | None = None,
    helpers: bool = False,
) -> DataFrame:
    """Add session columns to page views.

    A view starts a session when it is the visitor's first or more than ``gap`` seconds (second
    boundaries) after the one before. ``entry`` maps new columns to source columns taken from the first
    view of the session. Views without a visitor form one group whose ``session_id`` and session
    columns are NULL; with ``by_ip`` they get an id like any other address. A view without a timestamp
    comes last and is a session of its own. Visitor ids should have one
    length, or two visitors could share a session id. ``slice_seconds`` narrows all slices; ``hot_rows``
    counts first and cuts only slices with more views to single seconds. Views without a timestamp are one slice of their visitor, in the order of ``tie``;
    ``untimed_slice``, a number from 0 that grows with it, cuts them into several, so that many of them do not meet in a task. ``helpers`` keeps the previous timestamp, inactivity and new-session flag.
    """
    entry = dict(entry or {})
    seconds = min(slice_seconds or gap, gap)
    views = _sliced(df, visitor, ts, seconds, hot_rows, untimed_slice)
    order = [ts, *tie]

    aggs = [
        F.count(F.lit(1)).alias("_views"),
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
    ]
    if entry:
        aggs.append(F.min_by(F.struct(*[F.col(c).alias(n) for n, c in entry.items()]), F.struct(*order)).alias("_entry"))
    if domain:
        aggs.append(F.collect_set(domain).alias("_domains"))
    slices = views.groupBy(*_VISITOR, "_slice").agg(*aggs)

    along = Window.partitionBy(*_VISITOR).orderBy("_slice")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        slices.withColumn("_before", F.lag("_last").over(along))
        .withColumn("_views_before", F.coalesce(F.sum("_views").over(earlier), F.lit(0)))
        .withColumn("_views_all", F.sum("_views").over(Window.partitionBy(*_VISITOR)))
        # Each view of an untimed slice is a session: the slice has the number of its first one.
        .withColumn("_new", F.when(F.col("_slice") >= UNTIMED, F.col("_views")).when(seconds_between(F.col("_before"), F.col("_first")) <= gap, 0).otherwise(1))
        .withColumn("session_number", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.when(F.col("_slice") >= UNTIMED, F.col("_new") - 1).otherwise(0))
    )
    # The slices are partitioned by visitor already, so the windows over sessions need no shuffle.
    session = Window.partitionBy(*_VISITOR, "session_number")
    in_session = session.orderBy("_slice")
    totals = [
        F.coalesce(F.sum("_views").over(in_session.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_session_before"),
        F.sum("_views").over(session).alias("total_pages_in_session"),
        F.min("_first").over(session).alias("session_start_at"),
        F.max("_last").over(session).alias("session_end_at"),
    ]
    carried = [*_VISITOR, "_slice", "session_number", "_before", "_views_before", "_views_all"]
    if entry:
        totals.append(F.first("_entry").over(in_session).alias("_entry"))
    kept = [*carried, *(["_domains"] if domain else [])]
    slices = slices.select(*kept, *totals)
    if domain:
        slices = _with_session_domains(slices, by_ip)

    in_slice = Window.partitionBy(*_VISITOR, "_slice").orderBy(*order)
    rows = views.select(
        "*",
        F.row_number().over(in_slice).alias("_rn"),
        F.lag(ts).over(in_slice).alias("_prev"),
    ).join(slices, [*_VISITOR, "_slice"])

    untimed = F.col("_slice") >= UNTIMED
    rows = rows.withColumn("session_number", F.col("session_number") + F.when(untimed, F.col("_rn") - 1).otherwise(0))
    known = F.lit(True) if by_ip else ~F.col("_unknown")
    session_only = lambda c: F.when(known, c)
    previous = F.when(F.col("_rn") == 1, F.col("_before")).otherwise(F.col("_prev"))
    out = [
        *df.columns,
        (F.col("_views_before") + F.col("_rn")).alias("page_view_number"),
        F.col("session_number"),
        _session_id(by_ip).alias("session_id"),
    ]
    # Views without a visitor share one NULL session id, so they are numbered as one group.
    single = F.lit(1).cast("bigint")
    number = F.when(known & untimed, single).otherwise(
        F.when(known, F.col("_session_before")).otherwise(F.col("_views_before")) + F.col("_rn")
    )
    total = F.when(known & untimed, single).when(known, F.col("total_pages_in_session")).otherwise(F.col("_views_all"))
    out += [number.alias("page_number_in_session"), total.alias("total_pages_in_session")]
    out += [session_only(F.col(c)).alias(c) for c in ("session_start_at", "session_end_at")]
    out += [
        session_only(F.when(untimed, F.col(c)).otherwise(F.col("_entry").getField(n))).alias(n) for n, c in entry.items()
    ]
    if domain:
        own = F.array_compact(F.array(domain))
        domains = F.when(untimed, own).otherwise(F.col("domains_in_session"))
        out.append(session_only(F.size(domains)).alias("number_domains_in_session"))
        out.append(session_only(domains).alias("domains_in_session"))
    if helpers:
        inactive = seconds_between(previous, F.col(ts))
        out += [
            previous.alias("previous_tstamp"),
            inactive.alias("period_of_inactivity"),
            F.when(inactive <= gap, 0).otherwise(1).alias("new_session"),
        ]
    return rows.select(*out)


def merge_sessions(parts: DataFrame, visitor: str, gap: int = 1800, sums: Sequence[str] = ("views",)) -> DataFrame:
    """Whole sessions from parts of sessions: (visitor, session_start_at, session_end_at, sums).

    Parts come from views that were dealt over salts, times or batches; a part is an interval whose views are at most ``gap`` seconds apart. Parts of a visitor
    that start within one gap of each other are one session, so they are first summed per slice of a gap, which combines before the
    shuffle. What is left has at most one row for each gap of the calendar and visitor, and only these are put in order: no number of parts
    or views of one visitor meets in a task. NULL is a visitor like any other.
    """
    second = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    bounds = [F.min("session_start_at").alias("session_start_at"), F.max("session_end_at").alias("session_end_at")]
    totals = [F.sum(c).alias(c) for c in sums]
    slices = parts.groupBy(visitor, F.floor(second("session_start_at") / gap).alias("_slice")).agg(*bounds, *totals)
    along = Window.partitionBy(visitor).orderBy("_slice")
    before = F.max(second("session_end_at")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(second("session_start_at") - before <= gap, 0).otherwise(1)
    numbered = slices.withColumn("_new", fresh).withColumn("_session", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(visitor, "_session").agg(*bounds, *totals).drop("_session")


def sessionize_page_visits(
    views: DataFrame,
    referrers: DataFrame,
    *,
    gap: int = 1800,
    tie: Sequence[str] = (),
    campaign_logic: bool = False,
    by_ip: bool = False,
    hosts: SiteHosts | None = None,
    campaigns: Sequence[tuple] | None = None,
    slice_seconds: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Page views with attribution category and their session's entry attributes.

    Expects the page-view columns of a web-analytics export: anonymous_id, context_ip, timestamp,
    domain, path, referrer, referrer_host, campaign_*, utm_* and click ids; ``referrers`` has host and
    medium.
    """
    pages = with_referrer_medium(views, referrers)
    pages = pages.withColumn("page_attribution_category", page_attribution_category(hosts or SiteHosts()))
    pages = pages.withColumn("is_paid_category", is_paid_category(F.col("page_attribution_category")))
    pages = pages.withColumn("_referrer_domain", website_domain(F.col("referrer")))
    out = sessionize(
        pages,
        "context_ip" if by_ip else "anonymous_id",
        "timestamp",
        gap=gap,
        tie=tie,
        by_ip=by_ip,
        domain="domain",
        slice_seconds=slice_seconds,
        hot_rows=hot_rows,
        entry={
            "session_attribution_category": "page_attribution_category",
            "session_campaign_source": "campaign_source",
            "session_campaign_medium": "campaign_medium",
            "session_campaign_name": "campaign_name",
            "session_campaign_content": "campaign_content",
            "session_utm_term": "utm_term",
            "session_referrer": "_referrer_domain",
        },
    ).drop("_referrer_domain")
    if campaign_logic:
        out = out.withColumn("campaign_identifier", campaign_identifier(campaigns))
        out = out.withColumn("paid_campaign_platform", paid_platform())
    return out
