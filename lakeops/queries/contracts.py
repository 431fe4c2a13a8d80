"""Contract credits: orders as opportunities, their lines as quote lines, one contract per line number."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import business as B
from lakeops.operators import contracts as K
from lakeops.queries.registry import query, text
from lakeops.queries.relational import n_rows
from lakeops.queries.scalars import ARR_REASON_SQL, KIND_SQL, kind, skip_reason, transactions
from lakeops.session import materialize


SINCE = 1996


def inputs(t):
    """contracts, opportunities, quotes, quote lines"""
    opportunities = t.orders.select(
        F.col("o_orderkey").alias("opportunity_id"), F.col("o_custkey").alias("account_id"), kind().alias("opportunity_type"),
        F.lit(True).alias("is_closed"), (F.col("o_orderstatus") != "P").alias("is_won"), F.to_date("o_orderdate").alias("close_date"),
    )
    quotes = t.orders.select(
        F.col("o_orderkey").alias("quote_id"), F.col("o_orderkey").alias("opportunity_id"), (F.col("o_orderpriority") != "5-LOW").alias("is_syncing")
    )
    product = F.when(F.col("l_returnflag") == "R", "Extra Minutes").when(F.col("l_returnflag") == "A", "Base Credits").otherwise("Support")
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("quote_id"), F.col("l_linenumber").alias("term"), product.alias("product_name"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    terms = t.lineitem.select("l_orderkey", "l_linenumber").distinct()
    start = F.to_date(F.add_months("close_date", (F.col("l_linenumber") - 1) * 12))
    contracts = terms.join(opportunities.filter("opportunity_type <> 'Upsell'"), F.col("l_orderkey") == F.col("opportunity_id")).select(
        (F.col("opportunity_id") * 10 + F.col("l_linenumber")).alias("contract_id"), "opportunity_id", "account_id",
        start.alias("contract_start_date"), F.date_sub(F.add_months(start, 12), 1).alias("contract_end_date"),
    )
    return contracts, opportunities, quotes, lines


def all_inputs(t):
    """The same for queries that read the contracts several times: they are written once."""
    contracts, *others = inputs(t)
    return materialize(contracts, "contracts"), *others


def all_upsells(opportunities, quotes, lines):
    """The upsells, written once for the same reason."""
    return materialize(K.upsell_by_opportunity(opportunities, quotes, lines), "upsells")


INPUTS_SQL = f"""
opportunities as (select o_orderkey as opportunity_id, o_custkey as account_id, {KIND_SQL} as opportunity_type,
  o_orderstatus <> 'P' as is_won, cast(o_orderdate as date) as close_date, o_orderpriority <> '5-LOW' as is_syncing from orders),
lines as (select l_orderkey as opportunity_id, l_linenumber as term, case l_returnflag when 'R' then l_quantity else 0 end as minutes,
  case l_returnflag when 'A' then l_quantity else 0 end as credits from lineitem),
contracts as (
  select o.opportunity_id * 10 + l.l_linenumber as contract_id, o.opportunity_id, account_id,
    cast(close_date + to_months(12 * (l_linenumber - 1)) as date) as contract_start_date,
    cast(cast(close_date + to_months(12 * (l_linenumber - 1)) as date) + to_months(12) - interval 1 day as date) as contract_end_date
  from (select distinct l_orderkey, l_linenumber from lineitem) l join opportunities o on l_orderkey = o.opportunity_id where opportunity_type <> 'Upsell'
),
quoted as (
  select opportunity_id, term, cast(sum(credits) as bigint) as quoted_contracted_credits, cast(sum(minutes) as bigint) as quoted_contracted_minutes
  from opportunities join lines using (opportunity_id)
  where opportunity_type in ('New Business', 'Renewal') and is_won and is_syncing and year(close_date) >= {SINCE} group by 1, 2
),
aligned as (
  select c.*, quoted_contracted_credits, quoted_contracted_minutes
  from (select *, row_number() over (partition by opportunity_id order by contract_start_date, contract_id) as term_order from contracts) c
  left join (select *, row_number() over (partition by opportunity_id order by term) as term_order from quoted) q using (opportunity_id, term_order)
),
upsells as (
  select opportunity_id as upsell_id, account_id, close_date, cast(sum(credits) as bigint) as upsell_credits, cast(sum(minutes) as bigint) as upsell_minutes
  from opportunities join lines using (opportunity_id) where opportunity_type = 'Upsell' and is_won and is_syncing group by 1, 2, 3
),
matches as (select distinct upsell_id, c.opportunity_id from upsells u join contracts c on u.account_id = c.account_id and close_date between contract_start_date and contract_end_date),
last_contracts as (
  select upsell_id, contract_id from matches join contracts using (opportunity_id)
  qualify row_number() over (partition by upsell_id order by contract_end_date desc, contract_id desc) = 1
),
by_contract as (select contract_id, cast(sum(upsell_credits) as bigint) as upsell_credits, cast(sum(upsell_minutes) as bigint) as upsell_minutes
  from upsells join last_contracts using (upsell_id) group by 1),
amounts as (
  select contract_id, opportunity_id, account_id, contract_start_date, contract_end_date, coalesce(quoted_contracted_credits, 0) as qc, coalesce(quoted_contracted_minutes, 0) as qm,
    coalesce(upsell_credits, 0) as uc, coalesce(upsell_minutes, 0) as um from aligned left join by_contract using (contract_id)
),
sums as (
  select *, cast(coalesce(sum(qc) over before, 0) as bigint) as qc_before, cast(coalesce(sum(qc) over after, 0) as bigint) as qc_after,
    cast(coalesce(sum(qm) over before, 0) as bigint) as qm_before, cast(coalesce(sum(qm) over after, 0) as bigint) as qm_after,
    cast(coalesce(sum(uc) over before, 0) as bigint) as uc_before, cast(coalesce(sum(uc) over after, 0) as bigint) as uc_after,
    cast(coalesce(sum(um) over before, 0) as bigint) as um_before, cast(coalesce(sum(um) over after, 0) as bigint) as um_after
  from amounts window before as (partition by opportunity_id order by contract_start_date, contract_id rows between unbounded preceding and 1 preceding),
    after as (partition by opportunity_id order by contract_start_date, contract_id rows between 1 following and unbounded following)
)"""


@query("k1_quoted_by_term", f"with {INPUTS_SQL} select * from quoted")
def _(t):
    _, opportunities, quotes, lines = inputs(t)
    return K.quoted_by_term(opportunities, quotes, lines, SINCE)


@query("k2_term_alignment", f"with {INPUTS_SQL} select contract_id, quoted_contracted_credits, quoted_contracted_minutes from aligned")
def _(t):
    contracts, opportunities, quotes, lines = inputs(t)
    aligned = K.align_terms(contracts, K.quoted_by_term(opportunities, quotes, lines, SINCE))
    return aligned.select("contract_id", "quoted_contracted_credits", "quoted_contracted_minutes")


@query("k3_upsells", f"with {INPUTS_SQL} select upsell_id, account_id, upsell_credits, upsell_minutes from upsells")
def _(t):
    _, opportunities, quotes, lines = inputs(t)
    rows = K.upsell_by_opportunity(opportunities, quotes, lines)
    return rows.select(F.col("opportunity_id").alias("upsell_id"), "account_id", "upsell_credits", "upsell_minutes")


@query("k4_upsell_matches", f"with {INPUTS_SQL} select * from matches")
def _(t):
    contracts, *sales = all_inputs(t)
    return K.match_upsells(all_upsells(*sales), contracts)


@query("k5_last_contract", f"with {INPUTS_SQL} select * from last_contracts")
def _(t):
    contracts, *sales = all_inputs(t)
    return K.last_contract_of(contracts, K.match_upsells(all_upsells(*sales), contracts))


@query("k6_upsell_by_contract", f"with {INPUTS_SQL} select * from by_contract")
def _(t):
    contracts, *sales = all_inputs(t)
    upsells = all_upsells(*sales)
    return K.upsell_by_contract(upsells, K.last_contract_of(contracts, K.match_upsells(upsells, contracts)))


@query("k7_contract_credits", f"""with {INPUTS_SQL}
select contract_id, opportunity_id, account_id, cast(contract_start_date as varchar) as contract_start_date, cast(contract_end_date as varchar) as contract_end_date,
  qc as quoted_contracted_credits, qm as quoted_contracted_minutes, uc as upsell_credits, um as upsell_minutes,
  qc_before as sum_previous_terms_quoted_contracted_credits, qc_after as sum_future_terms_quoted_contracted_credits,
  qm_before as sum_previous_terms_quoted_contracted_minutes, qm_after as sum_future_terms_quoted_contracted_minutes,
  uc_before as sum_prior_terms_upsell_credits, uc_after as sum_future_terms_upsell_credits,
  um_before as sum_prior_terms_upsell_minutes, um_after as sum_future_terms_upsell_minutes from sums""")
def k7_contract_credits(t):
    rows = K.contract_credits(*all_inputs(t), SINCE)
    for c in ("contract_start_date", "contract_end_date"):
        rows = rows.withColumn(c, F.col(c).cast("string"))
    return rows


@query("k8_account_capacity", f"""with {INPUTS_SQL}
select account_id, contract_id, cast(contract_start_date as varchar) as contract_start_date, cast(contract_end_date as varchar) as contract_end_date,
  qc + uc as total_credits, qm + um as total_minutes from sums""")
def _(t):
    rows = K.account_capacity(K.contract_credits(*all_inputs(t), SINCE))
    return rows.select("account_id", "contract_id", text("contract_start_date"), text("contract_end_date"), "total_credits", "total_minutes")


@query("k9_arr_report", f"with {ARR_REASON_SQL} select coalesce(reason, 'corrected') as verdict, count(*) as transactions from verdicts group by 1")
def _(t):
    verdict = F.coalesce(skip_reason(), F.lit("corrected")).alias("verdict")
    return transactions(t).groupBy(verdict).agg(n_rows("transactions"))


_MONTHS_SQL = """
c as (select o_orderkey as contract_id, o_custkey as account_id, cast(o_orderdate as date) as start_date,
  cast(o_orderdate + to_months(3 + cast(o_orderkey % 12 as integer)) - interval 1 day as date) as end_date, o_totalprice as arr from orders)"""


@query("k10_arr_by_month", f"""with {_MONTHS_SQL},
m as (select *, unnest(generate_series(date_trunc('month', start_date), date_trunc('month', end_date), interval 1 month)) as arr_month,
  row_number() over (partition by account_id order by start_date, contract_id) = 1 as is_first_contract from c)
select contract_id, account_id, cast(cast(arr_month as date) as varchar) as arr_month, arr, date '1998-06-15' between start_date and end_date as is_active_contract,
  is_first_contract, arr_month = date_trunc('month', start_date) as is_first_month_of_contract, arr_month = date_trunc('month', end_date) as is_last_month_of_contract from m""")
def _(t):
    start = F.to_date("o_orderdate")
    contracts = t.orders.select(
        F.col("o_orderkey").alias("contract_id"), F.col("o_custkey").alias("account_id"), start.alias("start_date"),
        F.date_sub(F.add_months(start, (3 + F.col("o_orderkey") % 12).cast("int")), 1).alias("end_date"), F.col("o_totalprice").alias("arr"),
    )
    rows = K.arr_by_month(contracts, F.lit("1998-06-15").cast("date"), ["arr"])
    return rows.withColumn("arr_month", F.col("arr_month").cast("string"))
