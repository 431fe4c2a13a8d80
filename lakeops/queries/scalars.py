"""Scalar functions on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import business as B
from lakeops.functions import dates as D
from lakeops.functions import text as T
from lakeops.operators.joins import is_internal_user, is_personal_email, matches_any_pattern
from lakeops.queries.registry import query, text
from lakeops.queries.views import HOST_SQL

# Addresses and terms found nowhere in the tables, built from their columns.

def address():
    return F.concat(
        F.when(F.col("doc_id") % 5 == 0, F.lit(" ")).otherwise(F.lit("")),
        F.initcap(F.col("lang")), F.col("doc_id").cast("string"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("")).otherwise(F.lit("@")),
        F.col("source"), F.lit(".org"),
    )


ADDRESS_SQL = """case when doc_id % 5 = 0 then ' ' else '' end || upper(substr(lang, 1, 1)) || lower(substr(lang, 2)) || doc_id
  || case when doc_id % 7 = 0 then '' else '@' end || source || '.org'"""


@query("f1_clean_trailing_path", """
select page_id, case when path = '/' then '/' else rtrim(path, '/') end as path
from (select page_id, regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1) as path from pages)""")
def _(t):
    path = F.regexp_extract("url", r"^[a-z]+://[^/]+([^?#]*)", 1)
    return t.pages.select("page_id", T.clean_trailing_path(path).alias("path"))


# Whole texts percent-encoded in part: blanks as %20, and a stray escape in some, which cannot be decoded.

def encoded():
    return F.when(F.length("text") % 11 == 0, F.concat(F.col("text"), F.lit("%zz"))).otherwise(
        F.replace(F.replace(F.col("text"), F.lit("%"), F.lit("%25")), F.lit(" "), F.lit("%20"))
    )


ENCODED_SQL = "case when length(text) % 11 = 0 then text || '%zz' else replace(replace(text, '%', '%25'), ' ', '%20') end"


@query("f2_clean_utm_term", f"""
with raw as (select item_id, {ENCODED_SQL} as term, length(text) % 11 = 0 as broken from benchmark),
decoded as (select item_id, case when broken then replace(replace(term, '%20', ' '), '+', ' ') else url_decode(term) end as term from raw)
select item_id, lower(regexp_replace(regexp_replace(regexp_replace(term, '\\s{{2,}}', ' ', 'g'), '[\\r\\n\\t]', ' ', 'g'), '^\\s+|\\s+$', '', 'g')) as term
from decoded""")
def _(t):
    return t.benchmark.select("item_id", T.clean_utm_term(encoded()).alias("term"))


@query("f3_uri_percent_decode", f"""
select doc_id, md5(case when length(text) % 11 = 0 then null else url_decode({ENCODED_SQL}) end) as decoded from documents""")
def _(t):
    return t.documents.select("doc_id", F.md5(T.uri_percent_decode(encoded())).alias("decoded"))


@query("f4_email_cleaner", f"select doc_id, nullif(trim(lower({ADDRESS_SQL})), 'null') as email from documents")
def _(t):
    return t.documents.select("doc_id", T.email_cleaner(address()).alias("email"))


@query("f5_is_valid_email", f"""
select doc_id, regexp_matches({ADDRESS_SQL}, '^[a-zA-Z0-9._%+''-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$') as is_valid from documents""")
def _(t):
    return t.documents.select("doc_id", T.is_valid_email(address()).alias("is_valid"))


@query("f6_email_domain", f"select doc_id, split_part({ADDRESS_SQL}, '@', 2) as domain from documents")
def _(t):
    return t.documents.select("doc_id", T.email_domain(address()).alias("domain"))


@query("f7_website_domain", f"select page_id, {HOST_SQL.format('url')} as domain from pages")
def _(t):
    return t.pages.select("page_id", T.website_domain(F.col("url")).alias("domain"))


@query("f8_hash_string")
def _(t):
    return t.customer.select("c_custkey", T.hash_string(F.col("c_name")).alias("hashed"))


@query("f9_html_clean", """
select page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(
  regexp_replace(html, '<[^>]*>', ' ', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''),
  '[ \\t\\r\\n\\x0b\\f]+', ' ', 'g'))) as cleaned from pages""")
def _(t):
    return t.pages.select("page_id", F.md5(T.html_clean(F.col("html"))).alias("cleaned"))


def full_name():
    return F.concat("p_name", F.when(F.col("p_size") > 25, F.concat(F.lit(' "x" ('), F.col("p_brand"), F.lit(")"))).otherwise(
        F.when(F.col("p_size") < 5, F.lit(" <b>")).otherwise(F.lit(""))))
NAME_SQL = """p_name || case when p_size > 25 then ' "x" (' || p_brand || ')' when p_size < 5 then ' <b>' else '' end"""


@query("f10_name_clean", f"""
select p_partkey, case when n like '%<%' or n like '%>%' then 'unknown'
  else replace(regexp_replace(n, '\\s*\\(.*\\)', ''), '"', '') end as name
from (select p_partkey, {NAME_SQL} as n from part)""")
def _(t):
    return t.part.select("p_partkey", T.name_clean(full_name()).alias("name"))


def address_ip():
    return F.concat(F.col("c_nationkey").cast("string"), F.lit("."), F.col("c_custkey").cast("string"), F.lit(".0.1"))


@query("f11_is_bot_ip", """
with ips as (select c_custkey, c_nationkey || '.' || c_custkey || '.0.1' as ip from customer),
prefixes as (select case when n_regionkey = 4 then '%' || n_nationkey || '.0.1' else n_nationkey || '.1%' end as prefix
  from nation where n_regionkey in (0, 1, 4))
select c_custkey, exists (select 1 from prefixes where ip like prefix) as is_bot from ips""")
def _(t):
    key = F.col("n_nationkey").cast("string")
    prefix = F.when(F.col("n_regionkey") == 4, F.concat(F.lit("%"), key, F.lit(".0.1"))).otherwise(F.concat(key, F.lit(".1%")))
    prefixes = t.nation.filter(F.col("n_regionkey").isin(0, 1, 4)).select(prefix.alias("prefix"))
    rows = t.customer.select("c_custkey", address_ip().alias("ip"))
    return matches_any_pattern(rows, "ip", prefixes, "prefix", "is_bot").select("c_custkey", "is_bot")


@query("f12_is_internal_user", f"""
select doc_id, split_part(email, '@', 2) in (select source || '.org' from documents where lang = 'fr')
  or email = 'en1@web.org' as is_internal_user
from (select doc_id, lower(trim({ADDRESS_SQL})) as email from documents)""")
def _(t):
    rows = t.documents.select("doc_id", T.email_cleaner(address()).alias("email"))
    domains = t.documents.filter("lang = 'fr'").select(F.concat("source", F.lit(".org")).alias("domain"))
    return is_internal_user(rows, "email", domains, "domain", ["en1@web.org"]).select("doc_id", "is_internal_user")


@query("f13_is_personal_email", f"""
select doc_id, split_part(email, '@', 2) in (select source || '.org' from documents where lang = 'de') as is_personal_email
from (select doc_id, lower(trim({ADDRESS_SQL})) as email from documents)""")
def _(t):
    rows = t.documents.select("doc_id", T.email_cleaner(address()).alias("email"))
    domains = t.documents.filter("lang = 'de'").select(F.concat("source", F.lit(".org")).alias("domain"))
    return is_personal_email(rows, "email", domains, "domain").select("doc_id", "is_personal_email")


@query("f14_scores", "select event_id, coalesce(value >= 20, false) as is_engaged, coalesce(value > 0, false) as has_intent from events")
def _(t):
    return t.events.select(
        "event_id", B.is_engaged(F.col("value")).alias("is_engaged"), B.has_intent(F.col("value")).alias("has_intent")
    )


def kind():
    return F.element_at(F.array(F.lit("New Business"), F.lit("Renewal"), F.lit("Upsell")), (F.col("o_orderkey") % 3 + 1).cast("int"))


KIND_SQL = "case o_orderkey % 3 when 0 then 'New Business' when 1 then 'Renewal' else 'Upsell' end"


@query("f15_is_existing_business", f"select o_orderkey, {KIND_SQL} in ('Upsell', 'Renewal', 'Existing Business') as existing from orders")
def _(t):
    return t.orders.select("o_orderkey", B.is_existing_business(kind()).alias("existing"))


NEW_ARR_SQL = f"""
with lines as (
  select l_orderkey, sum(l_extendedprice) as annualized,
    sum(case when l_returnflag = 'R' then 1 else 0 end) as prorated, sum(case when l_returnflag <> 'R' then 1 else 0 end) as non_prorated,
    max(l_linenumber) as term
  from lineitem group by 1
),
deals as (
  select o_orderkey, {KIND_SQL} as kind, o_totalprice as year1, o_totalprice / 4 as prior, coalesce(term, 1) * 6 as term_months,
    coalesce(prorated, 0) as prorated, coalesce(non_prorated, 0) as non_prorated, coalesce(annualized, 0) as annualized
  from orders left join lines on o_orderkey = l_orderkey
)"""


def deals(t):
    """Orders as opportunities with their lines summed."""
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("annualized"),
        F.count_if(F.col("l_returnflag") == "R").alias("prorated"),
        F.count_if(F.col("l_returnflag") != "R").alias("non_prorated"),
        F.max("l_linenumber").alias("term"),
    )
    joined = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(
        "o_orderkey", kind().alias("kind"), F.col("o_totalprice").alias("year1"), (F.col("o_totalprice") / 4).alias("prior"),
        (F.coalesce("term", F.lit(1)) * 6).alias("term_months"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("prorated", "non_prorated", "annualized")],
    )


def deal_new_arr():
    names = ("kind", "prorated", "non_prorated", "annualized", "year1", "prior", "term_months")
    return B.new_arr(*[F.col(n) for n in names])


@query("f16_new_arr", f"""{NEW_ARR_SQL}
select o_orderkey, round(case
  when kind = 'Upsell' and prorated > 0 and non_prorated > 0 then annualized - prior
  when kind = 'Upsell' and prorated = 0 and non_prorated > 0 then year1 - prior
  when kind = 'New Business' then year1
  when term_months % 12 = 0 then year1 - prior
  else year1 * (12.0 / (term_months % 12)) - prior end, 4) as new_arr from deals""")
def _(t):
    return deals(t).select("o_orderkey", F.round(deal_new_arr(), 4).alias("new_arr"))


@query("f17_manual_mapping", """
select o_orderkey, o_orderpriority = '1-URGENT' and o_orderdate >= date '1998-01-01' as in_history,
  editor is null or editor in ('tool-a', 'tool-b') as allowable,
  editor is not null and editor not in ('tool-a', 'tool-b') as manual
from (select *, case o_orderstatus when 'F' then 'tool-a' when 'O' then 'person' end as editor from orders)""")
def _(t):
    editor = F.when(F.col("o_orderstatus") == "F", "tool-a").when(F.col("o_orderstatus") == "O", "person")
    tools = ["tool-a", "tool-b"]
    return t.orders.select(
        "o_orderkey",
        B.mapping_history_filter(F.col("o_orderpriority"), F.col("o_orderdate"), "1-URGENT", "1998-01-01").alias("in_history"),
        B.mapping_was_allowable(editor, tools).alias("allowable"),
        B.mapping_was_manual(editor, tools).alias("manual"),
    )


@query("f18_last_n_days", "select event_type, count(*) as n from events where ts >= date '2024-01-31' - 10 group by 1")
def _(t):
    recent = t.events.filter(D.last_n_days(F.col("ts"), 10, F.lit("2024-01-31")))
    return recent.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def stamp():
    return (
        F.when(F.col("event_type") == "click", F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(F.col("event_type") == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
    )


@query("f19_epoch_or_iso", """
select event_id, cast(case event_type when 'view' then ts when 'click' then date_trunc('second', ts)
  when 'signup' then date_trunc('second', ts) end as varchar) as at from events""")
def _(t):
    return t.events.select("event_id", D.epoch_or_iso_to_ts(stamp()).cast("string").alias("at"))


@query("f20_try_timestamp", """
select event_id, cast(case when event_type <> 'error' then date_trunc('second', ts) end as varchar) as at from events""")
def _(t):
    raw = F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), "props")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select("event_id", D.try_timestamp(raw).cast("string").alias("at"))


@query("f21_term_months", """
select o_orderkey, l_linenumber, l_shipdate,
  cast((year(after) - year(o_orderdate)) * 12 + month(after) - month(o_orderdate) - case when day(after) < day(o_orderdate) then 1 else 0 end as integer) as months
from (select *, l_shipdate + interval 1 day as after from orders join lineitem on o_orderkey = l_orderkey)""".replace("l_shipdate,\n", "cast(l_shipdate as varchar) as shipped,\n"))
def _(t):
    rows = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.select("o_orderkey", "l_linenumber", text("l_shipdate", "shipped"), B.term_months(F.col("o_orderdate"), F.col("l_shipdate")).alias("months"))


ARR_REASON_SQL = """
cents as (select *, cast(round(l_extendedprice * 100) as bigint) // 12 as q, cast(round(l_extendedprice * 100) as bigint) % 12 as r from lineitem),
txns as (
  select q + case when r > 6 or (r = 6 and q % 2 = 1) then 1 else 0 end as right_cents, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice as amount,
    case when l_returnflag = 'R' then null else l_extendedprice end as arr,
    case when l_returnflag = 'A' then floor(l_extendedprice * 100 / 12) / 100 end as mrr,
    case when l_linestatus = 'F' or l_linenumber > 2 then l_shipdate end as started, l_shipdate + to_months(cast(l_quantity as integer) // 3) - interval 1 day as ended
  from cents
),
verdicts as (
  select *, case
    when l_orderkey in (1, 2, 3) then 'excluded'
    when l_linenumber not in (1, 2, 3) then 'other item'
    when amount is null then 'no amount'
    when started is null or ended is null then 'no dates'
    when (year(ended + interval 1 day) - year(started)) * 12 + month(ended + interval 1 day) - month(started)
      - case when day(ended + interval 1 day) < day(started) then 1 else 0 end > 12 then 'long term'
    when arr is not null and mrr is not null and cast(round(mrr * 100) as bigint) = right_cents then 'already right'
  end as reason from txns
)"""


def transactions(t):
    """Lines as transactions with stored recurring amounts, some missing or wrong."""
    amount = F.col("l_extendedprice")
    months = F.make_ym_interval(F.lit(0), F.floor(F.col("l_quantity") / 3).cast("int"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", amount.alias("amount"),
        F.when(F.col("l_returnflag") != "R", amount).alias("arr"),
        F.when(F.col("l_returnflag") == "A", F.floor(amount * 100 / 12) / 100).alias("mrr"),
        F.when((F.col("l_linestatus") == "F") | (F.col("l_linenumber") > 2), F.col("l_shipdate")).alias("started"),
        (F.col("l_shipdate") + months - F.expr("interval 1 day")).alias("ended"),
    )


def skip_reason():
    c = F.col
    return B.arr_skip_reason(c("l_orderkey"), c("l_linenumber"), c("amount"), c("arr"), c("mrr"), c("started"), c("ended"), [1, 2, 3], [1, 2, 3])


@query("f22_arr_correction", f"""with {ARR_REASON_SQL}
select l_orderkey, l_linenumber, l_partkey, l_suppkey, reason is null as needs_correction, cast(amount as double) as right_arr,
  right_cents / 100 as right_mrr from verdicts""")
def _(t):
    amount = F.col("amount")
    return transactions(t).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", skip_reason().isNull().alias("needs_correction"),
        B.correct_arr(amount).cast("double").alias("right_arr"), B.correct_mrr(amount).cast("double").alias("right_mrr"),
    )


@query("f23_snake_key", """
select p_partkey, lower(regexp_replace(trim(' ' || p_brand || ' - ' || p_name), '[\\s-]+', '_', 'g')) as key from part""")
def _(t):
    raw = F.concat(F.lit(" "), "p_brand", F.lit(" - "), "p_name")
    return t.part.select("p_partkey", T.snake_key(raw).alias("key"))


# Workflow names and the definition each belongs to; callers add their own.
WORKFLOW_DEFINITIONS = {"signup": "signal.signup", "purchase": "signal.purchase"}


@query("f24_name_map", """
select event_id, case event_type when 'signup' then 'signal.signup' when 'purchase' then 'signal.purchase' else 'signal.activity' end as definition_key from events""")
def _(t):
    return t.events.select("event_id", B.name_map(F.col("event_type"), WORKFLOW_DEFINITIONS, "signal.activity").alias("definition_key"))


@query("f25_record_id", "select event_id, case when event_type <> 'view' then cast(event_id as varchar) else md5(props) end as record_id from events")
def _(t):
    known = F.when(F.col("event_type") != "view", F.col("event_id").cast("string"))
    return t.events.select("event_id", B.record_id(known, F.col("props")).alias("record_id"))


@query("f26_first_timestamp", """
select event_id, cast(case event_type when 'click' then date_trunc('second', ts)
  else date_trunc('day', ts) end as varchar) as observed_at from events""")
def _(t):
    payload = F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    broken = F.when(F.col("event_type") == "view", F.lit("soon"))
    parts = [F.date_format("ts", p) for p in ("yyyy", "MM", "dd")]
    return t.events.select("event_id", D.first_timestamp([broken, payload], parts).cast("string").alias("observed_at"))


@query("f27_base_plan_type", "select o_orderkey, split_part(replace(o_orderpriority, '-', '_'), '_', 1) as base from orders")
def _(t):
    return t.orders.select("o_orderkey", T.base_plan_type(F.replace("o_orderpriority", F.lit("-"), F.lit("_"))).alias("base"))


@query("f28_flag_outcome", f"""
select o_orderkey, case when qualified is not null and bucket <> 'NULL' and kind = 'New Business' and cast(o_orderdate as date) > date '1997-06-30' then
  case when o_orderstatus = 'F' then 'training' else 'prediction' end end as split
from (select *, {KIND_SQL} as kind, case when o_totalprice > 20000 then o_orderdate end as qualified,
  case when o_orderpriority = '5-LOW' then 'NULL' else o_orderpriority end as bucket from orders)""")
def _(t):
    qualified = F.when(F.col("o_totalprice") > 20000, F.col("o_orderdate"))
    bucket = F.when(F.col("o_orderpriority") == "5-LOW", "NULL").otherwise(F.col("o_orderpriority"))
    closed = F.col("o_orderstatus") == "F"
    return t.orders.select("o_orderkey", B.flag_outcome(qualified, bucket, closed, kind(), F.col("o_orderdate"), "1997-06-30").alias("split"))


@query("f29_text_tail", """
select doc_id, md5(right(text, 4000)) as tail, md5(left(text, 3000)) as head from documents""")
def _(t):
    return t.documents.select("doc_id", F.md5(T.text_tail(F.col("text"))).alias("tail"), F.md5(T.text_head(F.col("text"))).alias("head"))


@query("f30_clean_json_numbers", """
select event_id, case when event_type = 'error' then 0 else cast(json_extract_string(props, '$.k') as bigint) end as k from events""")
def _(t):
    raw = F.when(F.col("event_type") == "error", F.lit('{"k": Infinity, "m": NaN}')).otherwise(F.col("props"))
    parsed = F.from_json(T.clean_json_numbers(raw), "k bigint, m bigint")
    return t.events.select("event_id", parsed["k"].alias("k"))


@query("h6_business_date", """
select event_id, cast(cast((ts at time zone 'UTC') at time zone 'America/Los_Angeles' as date) - 1 as varchar) as snapshot_date from events""")
def _(t):
    return t.events.select("event_id", D.business_date(F.col("ts")).cast("string").alias("snapshot_date"))
