"""Marketing attribution of page views: category, paid flag, campaign and platform.

The rules are ordered; each function folds its rule table into one CASE expression, so nothing leaves
the JVM. Hosts that belong to the site's owner are not part of the rules but come in as ``SiteHosts``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Click identifiers that alone mark a paid click.
PAID_CLICK_IDS = [
    "gclid", "reddit_cid", "msclkid", "ttclid", "linkedin_campaign_id", "wbraid", "gbraid", "dclid",
]

# Campaign sources that name an AI assistant.
AI_SOURCES = [
    "anthropic", "anthropic.com", "character.ai", "chatgpt", "chatgpt.com", "claude", "claude.ai",
    "codeium", "codeium.com", "cohere", "cohere.ai", "copilot", "copilot.com", "copilot.microsoft.com",
    "cursor", "cursor.sh", "deepseek", "deepseek.com", "gemini", "gemini.google.com", "grok",
    "grok.com", "groq", "groq.com", "huggingface", "huggingface.co", "meta.ai", "mistral",
    "mistral.ai", "moge.ai", "openai", "openai.com", "perplexity", "perplexity.ai", "poe", "poe.com",
    "replit.com", "together.ai", "you.com",
]

# Campaign mediums and the category each stands for.
MEDIUM_CATEGORIES = {
    "email": "email",
    "newsletter": "newsletter", "data_elixir": "newsletter", "rss": "newsletter",
    "social": "social", "zalo": "social",
    "sponsorship": "sponsorship",
    "jobposting": "jobposting", "dynamitejobs-job-post": "jobposting",
    "blog": "blog",
    "events": "events",
    "referral": "referral",
    "ai": "ai",
}

# Landing paths (LIKE patterns) of visits that come from a search engine.
SEARCH_PATHS = [
    ("/pricing", "search-pricing"),
    ("/careers%", "search-careers"),
    ("/", "search-brand"),
    ("/cloud", "search-brand"),
    ("/blog%", "search-blog"),
    ("/guides%", "search-guides"),
    ("/glossary%", "search-glossary"),
    ("/vs%", "search-vs"),
    ("/integrations%", "search-integrations"),
]

# Categories that are paid for.
PAID_CATEGORIES = ["cpc", "paidsocial", "sponsorship"]

# Campaign source (LIKE pattern) of a paid view and its platform.
SOURCE_PLATFORMS = [
    ("bing", "bing"), ("adwords", "adwords"), ("reddit", "reddit"), ("google", "adwords"),
    ("linkedin", "linkedin"), ("dzone%", "dzone"),
]

# Click id of a paid view and its platform, where the source does not tell.
CLICK_PLATFORMS = [
    ("gclid", "adwords"), ("fbclid", "facebook"), ("msclkid", "microsoft"), ("twclid", "twitter"),
    ("ttclid", "tiktok"), ("wbraid", "google"), ("gbraid", "google"), ("dclid", "google"),
    ("linkedin_campaign_id", "linkedin"), ("reddit_cid", "reddit"),
]

# Campaign name, content (None for any), needs a reddit click id, identifier.
CAMPAIGN_IDS = [
    ("9124225-25-03-ABM_Airflow", "airlift_guide", False, "2202694925580706257"),
    ("9124225-25-03-ABM_Airflow", None, False, "2187501160110163210"),
    ("5531654-2025 Q1 | AI Campaign", None, True, "2175886033960630843"),
    ("8626009-25-02-eBook_Data-Platform-Fundamentals", None, True, "2251306549350750173"),
    ("5531654-2025%20Q1%20%7C%20AI%20Campaign", None, True, "2175886033960630843"),
]

# Search strings that name the referring site.
SEARCH_REFERRERS = {
    "?ref=producthunt": "https://www.producthunt.com/",
    "?ref=blef.fr": "https://www.blef.fr/",
    "?ref=blog.langchain.dev": "https://blog.langchain.dev/",
    "?ref=stackshare": "https://stackshare.io/",
    "?ref=ssp.sh": "https://www.ssp.sh/",
    "?ref=dedp.online/": "https://www.dedp.online/",
}


@dataclass(frozen=True)
class SiteHosts:
    """Hosts of the site's owner (LIKE patterns), by kind, with the category each kind gets."""

    docs: Sequence[str] = ()
    learning: Sequence[str] = ()
    own: Sequence[str] = ()
    product: Sequence[str] = ()
    docs_label: str = "docs"
    learning_label: str = "learning"
    own_label: str = "own-referrer"
    product_label: str = "product-referrer"


def _cases(rules: Sequence[tuple[Column, Column | str]], default: Column | str | None = None) -> Column:
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out if default is None else out.otherwise(default)


def _any_like(column: Column, patterns: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | column.like(p)
    return out


def with_referrer_medium(views: DataFrame, referrers: DataFrame) -> DataFrame:
    """Left lookup of the medium of the referring host.

    The planner broadcasts a lookup that is small in bytes; otherwise the join is by shuffle, where
    skewed hosts are split at run time.
    """
    lookup = referrers.select(F.col("host").alias("_host"), F.col("medium").alias("referrer_medium"))
    return views.join(lookup, F.col("referrer_host") == F.col("_host"), "left").drop("_host")


def page_attribution_category(hosts: SiteHosts | None = None) -> Column:
    """Category of a view from its click ids, campaign fields, referrer and path."""
    hosts = hosts or SiteHosts()
    c = F.col
    host, medium, path, via = c("referrer_host"), c("campaign_medium"), c("path"), c("referrer_medium")
    direct = host.isNull()

    rules: list[tuple[Column, Column | str]] = [(c(click).isNotNull(), "cpc") for click in PAID_CLICK_IDS]
    rules.append((medium.isin("cpc", "ppc"), "cpc"))
    rules.append((c("campaign_source").isin(AI_SOURCES) & (direct | (via == "ai")), "ai"))
    mapped = F.create_map(*[F.lit(x) for pair in MEDIUM_CATEGORIES.items() for x in pair])
    rules.append((medium.isNotNull(), F.coalesce(F.element_at(mapped, medium), F.lit("other-campaign"))))
    rules.append((c("fbclid").isNotNull() | c("twclid").isNotNull(), "social"))
    rules += [((via == "search") & path.like(p), label) for p, label in SEARCH_PATHS]
    rules.append((via == "search", "search-other"))
    rules.append((via.isNotNull(), via))
    rules += [
        (host.like("%.zoom.us"), "zoom"),
        (_any_like(host, hosts.docs), hosts.docs_label),
        (_any_like(host, hosts.learning), hosts.learning_label),
        (path.like("/blog%") & direct, "blog"),
        ((path == "/glossary") & direct, "glossary"),
        (path.like("/events%") & via.isNull(), "events"),
        (F.coalesce("campaign_source", "campaign_medium", "campaign_name", "utm_term").isNotNull(), "other-campaign"),
        (_any_like(host, hosts.own), hosts.own_label),
        (_any_like(host, hosts.product), hosts.product_label),
        (host.isNotNull(), "other-referrer"),
    ]
    return _cases(rules, "uncategorized")


def is_paid_category(category: Column) -> Column:
    return F.coalesce(category.isin(PAID_CATEGORIES), F.lit(False))


def campaign_identifier(campaigns: Sequence[tuple] | None = None) -> Column:
    """First numeric campaign field, a known campaign's id, the sponsorship label, or any name."""
    c = F.col
    numeric = lambda name: c(name).try_cast("decimal(38,0)").isNotNull()
    rules: list[tuple[Column, Column | str]] = [
        (numeric(name), c(name)) for name in ("utm_campaign", "utm_campaign_second")
    ]
    for name, content, by_reddit, identifier in CAMPAIGN_IDS if campaigns is None else campaigns:
        match = c("campaign_name") == name
        if content is not None:
            match = match & (c("campaign_content") == content)
        if by_reddit:
            match = match & c("reddit_cid").isNotNull()
        rules.append((match, F.lit(identifier)))
    sponsored = F.concat(
        F.lit("email_sponsorship_name_"), "campaign_name", F.lit("_content_"), "campaign_content"
    )
    rules.append(((c("campaign_source") == "email") & (c("campaign_medium") == "sponsorship"), sponsored))
    return _cases(rules, F.coalesce("campaign_name", "utm_campaign", "utm_content"))


def paid_platform() -> Column:
    """Advertising platform of a paid view; NULL for the others."""
    source = F.lower(F.col("campaign_source"))
    rules: list[tuple[Column, Column | str]] = [(source.like(p), label) for p, label in SOURCE_PLATFORMS]
    rules.append((source == "email", F.col("campaign_content")))
    rules += [(F.col(click).isNotNull(), label) for click, label in CLICK_PLATFORMS]
    return F.when(F.col("is_paid_category"), _cases(rules))


def referrer_from_search(search: Column, referrer: Column, mapping: Mapping[str, str] | None = None) -> Column:
    """The referrer, or the site that the search string names when there is none."""
    mapping = SEARCH_REFERRERS if mapping is None else mapping
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(referrer, F.element_at(table, search))
