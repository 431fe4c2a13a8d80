"""Business rules as Columns: scores, opportunity types, revenue figures, mapping edits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Opportunity types that count as business with an existing customer.
EXISTING_BUSINESS_TYPES = ["Upsell", "Renewal", "Existing Business"]

CENTS = "decimal(38,2)"


def is_engaged(score: Column, threshold: float = 20) -> Column:
    return F.coalesce(score >= threshold, F.lit(False))


def has_intent(score: Column) -> Column:
    return F.coalesce(score > 0, F.lit(False))


def is_existing_business(opportunity_type: Column) -> Column:
    return F.coalesce(opportunity_type.isin(EXISTING_BUSINESS_TYPES), F.lit(False))


def new_arr(
    opportunity_type: Column,
    prorated: Column,
    non_prorated: Column,
    annualized: Column,
    year1: Column,
    prior: Column,
    term_months: Column,
) -> Column:
    """New annual recurring revenue of an opportunity.

    An upsell with both kinds of lines is measured by its annualized lines, one with none prorated by
    year one; new business counts whole; every other deal is annualized by the remainder of its term
    over full years before the prior term is subtracted.
    """
    upsell = opportunity_type == "Upsell"
    rest = term_months % 12
    return (
        F.when(upsell & (prorated > 0) & (non_prorated > 0), annualized - prior)
        .when(upsell & (prorated == 0) & (non_prorated > 0), year1 - prior)
        .when(opportunity_type == "New Business", year1)
        .when(rest == 0, year1 - prior)
        .otherwise(year1 * (F.lit(12.0) / rest) - prior)
    )


def mapping_history_filter(field: Column, created: Column, field_name: str, since: str = "2025-01-01") -> Column:
    """Rows of a field history that belong to one mapping field, from a date on."""
    return (field == field_name) & (created >= F.lit(since).cast("date"))


def mapping_was_allowable(editor: Column, tool_accounts: Sequence[str]) -> Column:
    """No editor, or a tool account: the mapping may be overwritten."""
    return editor.isNull() | editor.isin(list(tool_accounts))


def mapping_was_manual(editor: Column, tool_accounts: Sequence[str]) -> Column:
    """A person made the edit: the mapping is to be respected."""
    return editor.isNotNull() & ~editor.isin(list(tool_accounts))


def name_map(key: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Look a key up in a small constant mapping."""
    if not mapping:
        return F.lit(default)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.element_at(table, key), F.lit(default))


def record_id(record: Column, payload: Column) -> Column:
    return F.coalesce(record, F.md5(payload))


def flag_outcome(
    qualified_on: Column,
    bucket: Column,
    closed: Column,
    opportunity_type: Column,
    created: Column,
    since: str = "2023-06-30",
) -> Column:
    """'training' for closed and 'prediction' for open new business that was qualified after a date."""
    usable = (
        qualified_on.isNotNull()
        & (bucket != "NULL")
        & (opportunity_type == "New Business")
        & (created.cast("date") > F.lit(since).cast("date"))
    )
    return F.when(usable & closed, "training").when(usable & ~closed, "prediction")


def term_months(start: Column, end: Column) -> Column:
    """Whole calendar months of a term whose end date is inclusive."""
    start = start.cast("date")
    after = F.date_add(end.cast("date"), 1)
    months = (F.year(after) - F.year(start)) * 12 + F.month(after) - F.month(start)
    return months - (F.day(after) < F.day(start)).cast("int")


def correct_arr(amount: Column) -> Column:
    """Amount at two decimals, half to even."""
    return F.bround(amount.cast("decimal(28,10)"), 2).cast(CENTS)


def correct_mrr(amount: Column) -> Column:
    """A twelfth of the amount at two decimals, half to even."""
    return F.bround(amount.cast("decimal(28,10)") / F.lit(12), 2).cast(CENTS)


def arr_skip_reason(
    txn: Column,
    item: Column,
    amount: Column,
    arr: Column,
    mrr: Column,
    start: Column,
    end: Column,
    items: Sequence[int],
    excluded: Sequence[int] = (),
    max_term: int = 12,
) -> Column:
    """Why a transaction needs no correction; NULL when its ARR or MRR is to be corrected."""
    same = lambda stored, right: F.coalesce(stored.cast("decimal(28,10)") == right, F.lit(False))
    return (
        F.when(txn.isin(list(excluded)), "excluded")
        .when(~F.coalesce(item.isin(list(items)), F.lit(False)), "other item")
        .when(amount.isNull(), "no amount")
        .when(start.isNull() | end.isNull(), "no dates")
        .when(term_months(start, end) > max_term, "long term")
        .when(same(arr, correct_arr(amount)) & same(mrr, correct_mrr(amount)), "already right")
    )


def needs_arr_correction(*args, **kwargs) -> Column:
    return arr_skip_reason(*args, **kwargs).isNull()
