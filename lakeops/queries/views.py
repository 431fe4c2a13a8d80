"""Shapes the queries need, derived from the test tables in both languages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.text import website_domain
from lakeops.operators.attribution import PAID_CLICK_IDS
from lakeops.queries.registry import Tables

EMPTY_CLICKS = [c for c in PAID_CLICK_IDS if c not in ("gclid", "reddit_cid", "msclkid")]


def page_views(t: Tables) -> DataFrame:
    """Events on the page their id points to; errors have no visitor, clicks no referrer."""
    n = t.pages.agg(F.count(F.lit(1))).scalar()
    k, url, host = F.col("k"), F.col("url"), F.col("host")
    joined = t.events.join(t.pages.select("page_id", "url"), F.col("event_id") % n == F.col("page_id"), "left")
    parsed = F.get_json_object("props", "$.k").cast("int").alias("k")
    return joined.select("event_id", "ts", "user_id", "event_type", "url", parsed, website_domain(url).alias("host")).select(
        "event_id",
        F.when(F.col("event_type") != "error", F.concat(F.lit("u"), F.lpad(F.col("user_id").cast("string"), 12, "0"))).alias("anonymous_id"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("10.0.0."), F.lpad(F.col("user_id").cast("string"), 12, "0"))).alias("context_ip"),
        F.col("ts").alias("timestamp"),
        host.alias("domain"),
        F.when(k < 5, "/pricing").when(k < 10, "/blog/a").when(k < 15, "/events/b")
        .otherwise(F.regexp_extract(url, r"^[a-z]+://[^/]+([^?#]*)", 1)).alias("path"),
        F.regexp_extract(url, r"(\?[^#]*)", 1).alias("search"),
        F.when(F.col("event_type") != "click", url).alias("referrer"),
        F.when(F.col("event_type") != "click", host).alias("referrer_host"),
        F.when(k >= 97, "chatgpt").when(k >= 94, "bing").when(k >= 91, "email").when(k >= 88, "DZone-x")
        .otherwise(F.nullif(F.regexp_extract(url, "utm_source=([a-z]+)", 1), F.lit(""))).alias("campaign_source"),
        F.when(k.between(50, 54), "cpc").when(k.between(55, 59), "rss").when(k.between(86, 96), "sponsorship")
        .when(k.between(65, 69), "zine").alias("campaign_medium"),
        F.when(k.between(50, 59), "spring").when(k.between(90, 93), "9124225-25-03-ABM_Airflow").alias("campaign_name"),
        F.when(k.between(90, 91), "airlift_guide").when(k == 92, "footer").alias("campaign_content"),
        F.when(k.between(56, 58), "Data%20Lake").alias("utm_term"),
        F.when(k.between(60, 62), "20250101").when(k.between(63, 64), "brand").alias("utm_campaign"),
        F.when(k == 63, "777").alias("utm_campaign_second"),
        F.when(k == 70, "banner").alias("utm_content"),
        F.when(k == 20, "g1").alias("gclid"),
        F.when(k == 21, "r1").alias("reddit_cid"),
        F.when(k == 22, "m1").alias("msclkid"),
        F.when(k == 23, "f1").alias("fbclid"),
        F.when(k == 24, "t1").alias("twclid"),
        *[F.lit(None).cast("string").alias(c) for c in EMPTY_CLICKS],
    )


def referrers(t: Tables) -> DataFrame:
    """Referring hosts with a medium, by the look of the host."""
    host = website_domain(F.col("url"))
    medium = (
        F.when(host.startswith("spam-farm"), "search").when(host.startswith("blog."), "social")
        .when(host.startswith("m."), "ai").when(host.endswith("example.org"), "search")
    )
    return t.pages.select(host.alias("host"), medium.alias("medium")).filter(F.col("medium").isNotNull()).distinct()


HOST_SQL = (
    "split_part(split_part(regexp_replace(regexp_replace({0}, '^[a-zA-Z0-9+.-]+://', ''), '^www\\.', '', 'i'), '/', 1), '?', 1)"
)

def page_views_sql(early: str = "", late: str = "") -> str:
    """The views of ``page_views`` and their categories; ``early`` and ``late`` are the cases of the owner's documentation and own hosts."""
    return _VIEWS_SQL + _CATEGORY_SQL.format(early=early, late=late)


_VIEWS_SQL = f"""
raw_views as (
  select e.*, p.url, cast(json_extract_string(e.props, '$.k') as integer) as k
  from events e left join pages p on e.event_id % (select count(*) from pages) = p.page_id
),
page_views as (
  select event_id,
    case when event_type <> 'error' then 'u' || lpad(cast(user_id as varchar), 12, '0') end as anonymous_id,
    case when event_type <> 'error' then '10.0.0.' || lpad(cast(user_id as varchar), 12, '0') end as context_ip,
    ts as "timestamp",
    {HOST_SQL.format('url')} as domain,
    case when k < 5 then '/pricing' when k < 10 then '/blog/a' when k < 15 then '/events/b'
      else regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1) end as path,
    regexp_extract(url, '(\\?[^#]*)', 1) as search,
    case when event_type <> 'click' then url end as referrer,
    case when event_type <> 'click' then {HOST_SQL.format('url')} end as referrer_host,
    case when k >= 97 then 'chatgpt' when k >= 94 then 'bing' when k >= 91 then 'email' when k >= 88 then 'DZone-x'
      else nullif(regexp_extract(url, 'utm_source=([a-z]+)', 1), '') end as campaign_source,
    case when k between 50 and 54 then 'cpc' when k between 55 and 59 then 'rss'
      when k between 86 and 96 then 'sponsorship' when k between 65 and 69 then 'zine' end as campaign_medium,
    case when k between 50 and 59 then 'spring' when k between 90 and 93 then '9124225-25-03-ABM_Airflow' end as campaign_name,
    case when k between 90 and 91 then 'airlift_guide' when k = 92 then 'footer' end as campaign_content,
    case when k between 56 and 58 then 'Data%20Lake' end as utm_term,
    case when k between 60 and 62 then '20250101' when k between 63 and 64 then 'brand' end as utm_campaign,
    case when k = 63 then '777' end as utm_campaign_second,
    case when k = 70 then 'banner' end as utm_content,
    case when k = 20 then 'g1' end as gclid,
    case when k = 21 then 'r1' end as reddit_cid,
    case when k = 22 then 'm1' end as msclkid,
    case when k = 23 then 'f1' end as fbclid,
    case when k = 24 then 't1' end as twclid
  from raw_views
),
hosts as (select distinct {HOST_SQL.format('url')} as host from pages),
referrers as (
  select host, case when host like 'spam-farm%' then 'search' when host like 'blog.%' then 'social'
    when host like 'm.%' then 'ai' when host like '%example.org' then 'search' end as medium
  from hosts
),"""

_CATEGORY_SQL = """
attributed as (
  select v.*, r.medium as referrer_medium,
    case
      when gclid is not null or reddit_cid is not null or msclkid is not null then 'cpc'
      when campaign_medium = 'cpc' then 'cpc'
      when campaign_source = 'chatgpt' and (referrer_host is null or r.medium = 'ai') then 'ai'
      when campaign_medium = 'rss' then 'newsletter'
      when campaign_medium = 'sponsorship' then 'sponsorship'
      when campaign_medium is not null then 'other-campaign'
      when fbclid is not null or twclid is not null then 'social'
      when r.medium = 'search' and path = '/pricing' then 'search-pricing'
      when r.medium = 'search' and path = '/' then 'search-brand'
      when r.medium = 'search' and path like '/blog%' then 'search-blog'
      when r.medium = 'search' then 'search-other'
      when r.medium is not null then r.medium
      {early}
      when path like '/blog%' and referrer_host is null then 'blog'
      when path like '/events%' then 'events'
      when coalesce(campaign_source, campaign_medium, campaign_name, utm_term) is not null then 'other-campaign'
      {late}
      when referrer_host is not null then 'other-referrer'
      else 'uncategorized' end as page_attribution_category
  from page_views v left join (select * from referrers where medium is not null) r on v.referrer_host = r.host
)"""

PAGE_VIEWS_SQL = page_views_sql()


def changes(t: Tables) -> DataFrame:
    """Events as a change log keyed by user."""
    op = F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I").otherwise("U")
    return t.events.select("user_id", "event_id", "event_type", "value", "props", op.alias("op"), "ts")


CHANGES_SQL = """
changes as (
  select user_id, event_id, event_type, value, props,
    case event_type when 'error' then 'D' when 'signup' then 'I' else 'U' end as op, ts
  from events
)"""
