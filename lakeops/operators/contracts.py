"""Credits of contracts: quoted by term, upsold, and cumulated over an opportunity's terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.joins import range_join
from lakeops.operators.ordered import ordered_scan
from lakeops.session import materialize

QUANTITIES = {"credits": "%Credits%", "minutes": "%Minutes%"}


def _amounts() -> list[Column]:
    """The quantity of a line for each kind of product that it is."""
    return [F.when(F.col("product_name").like(p), F.col("quantity")).alias(n) for n, p in QUANTITIES.items()]


def sold_by_term(opportunities: DataFrame, quotes: DataFrame, lines: DataFrame) -> DataFrame:
    """Credits and minutes of won opportunities of all kinds per term, from the lines of their syncing quotes.

    One row per opportunity and term: the lines are read and aggregated once for what was quoted and what was upsold. Lines travel as ids and numbers, without the product's name.
    """
    won = opportunities.filter(F.col("is_closed") & F.col("is_won")).select("opportunity_id", "account_id", "opportunity_type", "close_date")
    syncing = quotes.filter("is_syncing").select("quote_id", "opportunity_id")
    rows = won.join(syncing, "opportunity_id").join(lines.select("quote_id", "term", *_amounts()), "quote_id")
    totals = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in QUANTITIES]
    return rows.groupBy("opportunity_id", "account_id", "opportunity_type", "close_date", "term").agg(*totals)


def quoted_terms(sold: DataFrame, since_year: int = 2024) -> DataFrame:
    """What ``sold_by_term`` has of new business and renewals."""
    kept = sold.filter(F.col("opportunity_type").isin("New Business", "Renewal") & (F.year("close_date") >= since_year))
    return kept.select("opportunity_id", "term", *[F.col(n).alias(f"quoted_contracted_{n}") for n in QUANTITIES])


def upsold(sold: DataFrame) -> DataFrame:
    """What ``sold_by_term`` has of upsells, per opportunity."""
    kept = sold.filter(F.col("opportunity_type") == "Upsell")
    return kept.groupBy("opportunity_id", "account_id", "close_date").agg(*[F.sum(n).alias(f"upsell_{n}") for n in QUANTITIES])


def quoted_by_term(opportunities: DataFrame, quotes: DataFrame, lines: DataFrame, since_year: int = 2024) -> DataFrame:
    """Quoted credits and minutes per opportunity and term, for won new business and renewals."""
    return quoted_terms(sold_by_term(opportunities, quotes, lines), since_year)


def align_terms(contracts: DataFrame, quoted: DataFrame) -> DataFrame:
    """The nth contract of an opportunity by start date gets its nth quoted term.

    Quoted terms are distinct small numbers, a few dozen for an opportunity at most, so a plain window numbers them.
    """
    numbered = ordered_scan(
        contracts, ["opportunity_id"], ["contract_start_date", "contract_id"], F.year("contract_start_date"),
        row_number="term_order",
    )
    nth = F.row_number().over(Window.partitionBy("opportunity_id").orderBy(F.col("term").asc_nulls_last()))
    terms = quoted.withColumn("term_order", nth).drop("term")
    return numbered.join(terms, ["opportunity_id", "term_order"], "left")


def upsell_by_opportunity(opportunities: DataFrame, quotes: DataFrame, lines: DataFrame) -> DataFrame:
    """Upsold credits and minutes per won upsell."""
    return upsold(sold_by_term(opportunities, quotes, lines))


def match_upsells(upsells: DataFrame, contracts: DataFrame) -> DataFrame:
    """Pairs (upsell, opportunity) where the upsell closed inside a contract of the same account.

    Both are read more than once: hand in upsells and contracts that are written.
    """
    points = upsells.select(F.col("opportunity_id").alias("upsell_id"), "account_id", "close_date")
    periods = contracts.select("account_id", "opportunity_id", "contract_start_date", "contract_end_date")
    found = range_join(points, periods, ["account_id"], "close_date", "contract_start_date", "contract_end_date")
    return found.select("upsell_id", "opportunity_id").distinct()


def last_contract_of(contracts: DataFrame, matches: DataFrame) -> DataFrame:
    """The last contract by end date among the opportunities matched to each upsell.

    Both steps are aggregations, which combine before they shuffle.
    """
    latest = F.struct("contract_end_date", "contract_id")
    last = contracts.groupBy("opportunity_id").agg(F.max(latest).alias("_last"))
    return matches.join(last, "opportunity_id").groupBy("upsell_id").agg(F.max("_last").alias("_last")).select(
        "upsell_id", F.col("_last.contract_id").alias("contract_id")
    )


def upsell_by_contract(upsells: DataFrame, last: DataFrame) -> DataFrame:
    sold = upsells.withColumnRenamed("opportunity_id", "upsell_id").join(last, "upsell_id")
    return sold.groupBy("contract_id").agg(
        F.sum("upsell_credits").alias("upsell_credits"), F.sum("upsell_minutes").alias("upsell_minutes")
    )


def contract_amounts(aligned: DataFrame, by_contract: DataFrame) -> DataFrame:
    """Contracts with quoted and upsold amounts, 0 where there are none."""
    amounts = [f"{kind}_{n}" for kind in ("quoted_contracted", "upsell") for n in QUANTITIES]
    rows = aligned.join(by_contract, "contract_id", "left")
    return rows.select(
        "contract_id", "opportunity_id", "account_id", "contract_start_date", "contract_end_date",
        *[F.coalesce(F.col(a), F.lit(0)).alias(a) for a in amounts],
    )


def contract_sums(rows: DataFrame) -> DataFrame:
    """Amounts of contracts and their sums over the opportunity's earlier and later terms."""
    before, after = {}, {}
    for n in QUANTITIES:
        before[f"sum_previous_terms_quoted_contracted_{n}"] = f"quoted_contracted_{n}"
        after[f"sum_future_terms_quoted_contracted_{n}"] = f"quoted_contracted_{n}"
        before[f"sum_prior_terms_upsell_{n}"] = f"upsell_{n}"
        after[f"sum_future_terms_upsell_{n}"] = f"upsell_{n}"
    return ordered_scan(
        rows, ["opportunity_id"], ["contract_start_date", "contract_id"], F.year("contract_start_date"),
        before=before, after=after,
    )


def contract_credits(
    contracts: DataFrame, opportunities: DataFrame, quotes: DataFrame, lines: DataFrame, since_year: int = 2024
) -> DataFrame:
    """All of the above: contracts with quoted, upsold and cumulated credits and minutes.

    Narrow aggregates that later steps read more than once are written in between: what was sold by opportunity and term, the upsells, and the amounts of the
    contracts, whose cumulation goes over them twice.
    """
    sold = materialize(sold_by_term(opportunities, quotes, lines), "sold")
    upsells = materialize(upsold(sold), "upsells")
    last = last_contract_of(contracts, match_upsells(upsells, contracts))
    aligned = align_terms(contracts, quoted_terms(sold, since_year))
    return contract_sums(materialize(contract_amounts(aligned, upsell_by_contract(upsells, last)), "amounts"))


def account_capacity(credits: DataFrame, account_id: object | None = None) -> DataFrame:
    """Total credits and minutes per contract, optionally of one account."""
    rows = credits if account_id is None else credits.filter(F.col("account_id") == account_id)
    return rows.select(
        "account_id", "contract_id", "contract_start_date", "contract_end_date",
        (F.col("quoted_contracted_credits") + F.col("upsell_credits")).alias("total_credits"),
        (F.col("quoted_contracted_minutes") + F.col("upsell_minutes")).alias("total_minutes"),
    )


def arr_by_month(contracts: DataFrame, today: Column, carry: list[str]) -> DataFrame:
    """One row per contract and month, with flags for its first and last month and its state today.

    ``contracts`` has contract_id, account_id, start_date, end_date. The months of a contract come from
    its own dates, so only the account's earliest start needs an aggregation.
    """
    earliest = contracts.groupBy("account_id").agg(F.min(F.struct("start_date", "contract_id")).alias("_first"))
    first_month, last_month = F.trunc("start_date", "month"), F.trunc("end_date", "month")
    rows = contracts.join(earliest, "account_id", "left").withColumn(
        "arr_month", F.explode(F.sequence(first_month, last_month, F.expr("interval 1 month")))
    )
    return rows.select(
        "contract_id", "account_id", "arr_month", *carry,
        ((F.col("start_date") <= today) & (today <= F.col("end_date"))).alias("is_active_contract"),
        F.coalesce(F.col("_first.contract_id") == F.col("contract_id"), F.lit(False)).alias("is_first_contract"),
        (F.col("arr_month") == first_month).alias("is_first_month_of_contract"),
        (F.col("arr_month") == last_month).alias("is_last_month_of_contract"),
    )
