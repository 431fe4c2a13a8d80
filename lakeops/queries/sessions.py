"""Sessions and attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators.attribution import (
    SEARCH_REFERRERS,
    SiteHosts,
    campaign_identifier,
    is_paid_category,
    page_attribution_category,
    paid_platform,
    referrer_from_search,
    with_referrer_medium,
)
from lakeops.operators.sessions import sessionize, sessionize_page_visits
from lakeops.queries.registry import Tables, query, text
from lakeops.queries.views import HOST_SQL, PAGE_VIEWS_SQL, page_views, page_views_sql, referrers

NUMBERED_SQL = """
numbered as (
  select *, row_number() over w as page_view_number, lag(ts) over w as previous_tstamp
  from events window w as (partition by user_id order by ts, event_id)
),
flagged as (
  select *, date_diff('second', previous_tstamp, ts) as period_of_inactivity,
    case when date_diff('second', previous_tstamp, ts) <= 1800 then 0 else 1 end as new_session
  from numbered
),
sessioned as (
  select *, cast(sum(new_session) over (partition by user_id order by page_view_number) as bigint) as session_number
  from flagged
)"""


def _views(t: Tables, **options):
    return sessionize(t.events, "user_id", "ts", tie=["event_id"], **options)


@query("x1_view_numbers", f"with {NUMBERED_SQL} select event_id, page_view_number, cast(previous_tstamp as varchar) as previous_tstamp from numbered")
def _(t):
    return _views(t, helpers=True).select("event_id", "page_view_number", text("previous_tstamp"))


@query("x2_inactivity", f"with {NUMBERED_SQL} select event_id, period_of_inactivity, new_session from flagged")
def _(t):
    return _views(t, helpers=True).select("event_id", "period_of_inactivity", "new_session")


@query("x3_session_numbers", f"with {NUMBERED_SQL} select event_id, session_number from sessioned")
def _(t):
    return _views(t).select("event_id", "session_number")


@query("x3_untimed_views", """
with v as (select event_id, case when event_id % 4 > 0 then user_id end as visitor, case when event_id % 3 > 0 then ts end as seen_at from events),
n as (select *, row_number() over w as page_view_number, lag(seen_at) over w as previous from v window w as (partition by visitor order by seen_at nulls last, event_id)),
f as (select *, case when date_diff('second', previous, seen_at) <= 1800 then 0 else 1 end as fresh from n),
s as (select *, cast(sum(fresh) over (partition by visitor order by page_view_number) as bigint) as session_number from f)
select event_id, page_view_number, session_number, cast(previous as varchar) as previous_tstamp,
  case when visitor is null then page_view_number else row_number() over (partition by visitor, session_number order by page_view_number) end as page_number_in_session from s""")
def _(t):
    """A third of the views has no time and a quarter no visitor; the untimed ones are cut into slices of a thousand ids."""
    views = t.events.select("event_id", F.when(F.col("event_id") % 4 > 0, F.col("user_id")).alias("visitor"), F.when(F.col("event_id") % 3 > 0, F.col("ts")).alias("at"))
    rows = sessionize(views, "visitor", "at", tie=["event_id"], untimed_slice=F.floor(F.col("event_id") / 1000), helpers=True)
    return rows.select("event_id", "page_view_number", "session_number", text("previous_tstamp"), "page_number_in_session")


@query("x4_session_ids", f"with {NUMBERED_SQL} select event_id, md5(cast(user_id as varchar) || session_number) as session_id from sessioned")
def _(t):
    return _views(t).select("event_id", "session_id")


@query("x5_pages_in_session", f"""with {NUMBERED_SQL}
select event_id,
  row_number() over (partition by user_id, session_number order by ts, event_id) as page_number_in_session,
  count(*) over (partition by user_id, session_number) as total_pages_in_session
from sessioned""")
def _(t):
    return _views(t).select("event_id", "page_number_in_session", "total_pages_in_session")


@query("x6_entry_attribution", f"""with {NUMBERED_SQL}
select event_id, first_value(event_type) over w as entry_type, first_value(value) over w as entry_value
from sessioned window w as (partition by user_id, session_number order by ts, event_id
  rows between unbounded preceding and unbounded following)""")
def _(t):
    return _views(t, entry={"entry_type": "event_type", "entry_value": "value"}).select("event_id", "entry_type", "entry_value")


@query("x7_session_stats", f"""with {NUMBERED_SQL}
select user_id, session_number, cast(min(ts) as varchar) as session_start_at, cast(max(ts) as varchar) as session_end_at,
  count(distinct event_type) as number_domains_in_session,
  array_to_string(list_sort(list(distinct event_type)), ',') as domains_in_session
from sessioned group by 1, 2""")
def _(t):
    rows = _views(t, domain="event_type").filter("page_number_in_session = 1")
    return rows.select(
        "user_id", "session_number", text("session_start_at"), text("session_end_at"),
        F.col("number_domains_in_session").cast("bigint").alias("number_domains_in_session"),
        F.array_join("domains_in_session", ",").alias("domains_in_session"),
    )


SESSIONIZED_SQL = f"""with {PAGE_VIEWS_SQL},
n as (
  select *, row_number() over w as page_view_number, lag("timestamp") over w as previous_tstamp
  from attributed window w as (partition by {{who}} order by "timestamp", event_id)
),
f as (select *, case when date_diff('second', previous_tstamp, "timestamp") <= 1800 then 0 else 1 end as new_session from n),
s as (select *, cast(sum(new_session) over (partition by {{who}} order by page_view_number) as bigint) as session_number from f),
i as (select *, {{sid}} as session_id,
  page_attribution_category in ('cpc', 'paidsocial', 'sponsorship') as is_paid_category from s),
p as (
  select *, row_number() over (partition by session_id order by "timestamp", event_id) as page_number_in_session,
    count(*) over (partition by session_id) as total_pages_in_session from i
),
entry as (
  select session_id, page_attribution_category as session_attribution_category, campaign_source as session_campaign_source,
    campaign_medium as session_campaign_medium, campaign_name as session_campaign_name,
    campaign_content as session_campaign_content, utm_term as session_utm_term, {HOST_SQL.format('referrer')} as session_referrer
  from p where page_number_in_session = 1 and session_id is not null
),
stats as (
  select session_id, cast(min("timestamp") as varchar) as session_start_at, cast(max("timestamp") as varchar) as session_end_at,
    count(distinct domain) as number_domains_in_session,
    array_to_string(list_sort(list(distinct domain) filter (domain is not null)), ',') as domains_in_session
  from p where session_id is not null group by 1
)
select p.event_id, p.page_view_number, p.session_number, p.session_id, p.page_attribution_category, p.is_paid_category,
  p.page_number_in_session, p.total_pages_in_session, entry.* exclude (session_id), stats.* exclude (session_id){{campaign}}
from p left join entry using (session_id) left join stats using (session_id)"""

CAMPAIGN_IDENTIFIER_SQL = """
  case when try_cast(utm_campaign as decimal(38,0)) is not null then utm_campaign
    when try_cast(utm_campaign_second as decimal(38,0)) is not null then utm_campaign_second
    when campaign_name = '9124225-25-03-ABM_Airflow' and campaign_content = 'airlift_guide' then '2202694925580706257'
    when campaign_name = '9124225-25-03-ABM_Airflow' then '2187501160110163210'
    when campaign_source = 'email' and campaign_medium = 'sponsorship'
      then 'email_sponsorship_name_' || campaign_name || '_content_' || campaign_content
    else coalesce(campaign_name, utm_campaign, utm_content) end as campaign_identifier"""

PAID_PLATFORM_SQL = """
  case when not is_paid_category then null
    when lower(campaign_source) = 'bing' then 'bing'
    when lower(campaign_source) like 'dzone%' then 'dzone'
    when lower(campaign_source) = 'email' then campaign_content
    when gclid is not null then 'adwords' when fbclid is not null then 'facebook'
    when msclkid is not null then 'microsoft' when twclid is not null then 'twitter'
    when reddit_cid is not null then 'reddit' end as paid_campaign_platform"""

CAMPAIGN_SQL = f",{CAMPAIGN_IDENTIFIER_SQL},{PAID_PLATFORM_SQL}"

_SESSION_COLUMNS = [
    "event_id", "page_view_number", "session_number", "session_id", "page_attribution_category", "is_paid_category",
    "page_number_in_session", "total_pages_in_session", "session_attribution_category", "session_campaign_source",
    "session_campaign_medium", "session_campaign_name", "session_campaign_content", "session_utm_term", "session_referrer",
]


def _session_output(df, *more):
    return df.select(
        *_SESSION_COLUMNS, text("session_start_at"), text("session_end_at"),
        F.col("number_domains_in_session").cast("bigint").alias("number_domains_in_session"),
        F.array_join("domains_in_session", ",").alias("domains_in_session"), *more,
    )


@query("x8_sessionize", SESSIONIZED_SQL.format(
    who="anonymous_id", sid="md5(anonymous_id || session_number)", campaign=CAMPAIGN_SQL))
def x8_sessionize(t):
    rows = sessionize_page_visits(page_views(t), referrers(t), tie=["event_id"], campaign_logic=True)
    return _session_output(rows, "campaign_identifier", "paid_campaign_platform")


@query("x8_sessionize_by_ip", SESSIONIZED_SQL.format(
    who="context_ip", sid="md5(coalesce(context_ip, '') || session_number)", campaign=""))
def _(t):
    return _session_output(sessionize_page_visits(page_views(t), referrers(t), tie=["event_id"], by_ip=True))


def _attributed(t: Tables, hosts: SiteHosts | None = None):
    pages = with_referrer_medium(page_views(t), referrers(t))
    pages = pages.withColumn("page_attribution_category", page_attribution_category(hosts))
    return pages.withColumn("is_paid_category", is_paid_category(F.col("page_attribution_category")))


@query("x9_page_category", f"with {PAGE_VIEWS_SQL} select event_id, page_attribution_category from attributed")
def _(t):
    return _attributed(t).select("event_id", "page_attribution_category")


_OWNER_SQL = page_views_sql(
    "when referrer_host like '%pills%' then 'manual' when referrer_host like 'th%h.example.com' then 'academy'",
    "when referrer_host like '%.example.com' then 'own-referrer' when referrer_host like '%.example.net' then 'app-referrer'",
)


@query("x9_owner_hosts", f"with {_OWNER_SQL} select event_id, page_attribution_category from attributed")
def _(t):
    """Hosts of the site's owner, by kind: documentation, courses, own sites, the product."""
    hosts = SiteHosts(docs=["%pills%"], learning=["th%h.example.com"], own=["%.example.com"], product=["%.example.net"], docs_label="manual", learning_label="academy", product_label="app-referrer")
    return _attributed(t, hosts).select("event_id", "page_attribution_category")


@query("x10_paid_flag", f"with {PAGE_VIEWS_SQL} select page_attribution_category in ('cpc', 'paidsocial', 'sponsorship') as is_paid_category, count(*) as views from attributed group by 1")
def _(t):
    return _attributed(t).groupBy("is_paid_category").agg(F.count(F.lit(1)).alias("views"))


@query("x11_campaign_identifier", f"with {PAGE_VIEWS_SQL} select event_id, {CAMPAIGN_IDENTIFIER_SQL} from page_views")
def _(t):
    return page_views(t).select("event_id", campaign_identifier().alias("campaign_identifier"))


@query("x12_paid_platform", f"""with {PAGE_VIEWS_SQL},
a as (select *, page_attribution_category in ('cpc', 'paidsocial', 'sponsorship') as is_paid_category from attributed)
select event_id, {PAID_PLATFORM_SQL} from a""")
def _(t):
    return _attributed(t).select("event_id", paid_platform().alias("paid_campaign_platform"))


@query("x13_referrer_lookup", f"with {PAGE_VIEWS_SQL} select referrer_host, referrer_medium, count(*) as views from attributed group by 1, 2")
def _(t):
    rows = with_referrer_medium(page_views(t), referrers(t))
    return rows.groupBy("referrer_host", "referrer_medium").agg(F.count(F.lit(1)).alias("views"))


@query("x14_referrer_from_search", f"""with {PAGE_VIEWS_SQL}
select event_id, coalesce(referrer, case search when '?utm_source=feed' then 'https://feed.example.com/' end) as referrer from page_views""")
def _(t):
    found = referrer_from_search(F.col("search"), F.col("referrer"), {"?utm_source=feed": "https://feed.example.com/"})
    return page_views(t).select("event_id", found.alias("referrer"))


_SEARCHES_SQL = " ".join(f"when {i} then '{search}'" for i, search in enumerate(SEARCH_REFERRERS))
_SITES_SQL = ", ".join(f"('{search}', '{site}')" for search, site in SEARCH_REFERRERS.items())


@query("x14_all_search_referrers", f"""
with v as (select event_id, case event_id % {len(SEARCH_REFERRERS) + 2} {_SEARCHES_SQL} when {len(SEARCH_REFERRERS)} then '?ref=else' end as search,
  case when event_type = 'click' then 'https://kept.example.com/' end as referrer from events)
select event_id, coalesce(v.referrer, site) as referrer from v left join (values {_SITES_SQL}) m(search, site) using (search)""")
def _(t):
    """Every pair of the mapping, a search it does not know, and none."""
    turn = F.col("event_id") % (len(SEARCH_REFERRERS) + 2)
    search = F.when(turn == len(SEARCH_REFERRERS), "?ref=else")
    for i, text_of in enumerate(SEARCH_REFERRERS):
        search = search.when(turn == i, text_of)
    referrer = F.when(F.col("event_type") == "click", "https://kept.example.com/")
    return t.events.select("event_id", referrer_from_search(search, referrer).alias("referrer"))
