"""Cash-flow reconciliation of a block by plan group.

Inputs: ``snapshot`` (policy_number, set_month, plangroup, stat_reserve,
interest_credited, bonus_credited, expense_charges), ``premium`` (set_month,
plangroup, total_premium, renewal_premium, initial_commission) and
``withdrawals`` (set_month, plangroup, withdrawal_type, withdrawal_amount).

Each input is summed in one grouped aggregate, whatever the number of plan
groups, lines and months; only new policies need a second look at the snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cedeflow import fixed_values as fixed
from cedeflow.functions.factors import inflation
from cedeflow.functions.months import in_months, month_list
from cedeflow.operators.new_policies import count_new_policies
from cedeflow.operators.report_lines import Line, complete

KEYS = ("set_month", "plangroup")


@dataclass(frozen=True)
class GroupTerms:
    """What distinguishes one block's reconciliation from another's.

    The issue and admin expense count either policies of the snapshot (issue:
    only those absent the month before) or rows of the premium table.
    """

    plan_groups: tuple[str, ...]
    share: Decimal
    issue_cost: float
    admin_cost_per_year: float
    inflation_rate: float
    inflation_base_year: int
    expense_share: float = 1.0
    expenses_from_premium: bool = False
    issue_lines_first: bool = False


TERMS_95 = GroupTerms(
    plan_groups=fixed.PLAN_GROUPS_95,
    share=Decimal("0.95"),
    issue_cost=180,
    admin_cost_per_year=120,
    inflation_rate=0.02,
    inflation_base_year=2023,
)
TERMS_50 = GroupTerms(
    plan_groups=fixed.PLAN_GROUPS_50,
    share=Decimal("0.5"),
    issue_cost=37.5,
    admin_cost_per_year=20,
    inflation_rate=0.03,
    inflation_base_year=2024,
    expense_share=0.5,
    expenses_from_premium=True,
    issue_lines_first=True,
)


def _of_groups(rows: DataFrame, terms: GroupTerms, months: Sequence[str] | None) -> DataFrame:
    return in_months(rows, months).filter(F.col("plangroup").isin(list(terms.plan_groups)))


def _long(totals: DataFrame, types: Sequence[str]) -> DataFrame:
    return totals.select(*KEYS, *[F.col(t).cast("double").alias(t) for t in types]).unpivot(
        list(KEYS), list(types), "type", "total"
    )


def _issue_cost(terms: GroupTerms) -> Column:
    return F.col("n") * F.lit(float(terms.issue_cost)) * F.lit(terms.expense_share)


def _admin_cost(terms: GroupTerms) -> Column:
    """The monthly admin expense of ``n`` policies, inflated from the base year."""
    return (
        F.col("n")
        * F.lit(terms.admin_cost_per_year / 12)
        * inflation(F.col("set_month"), terms.inflation_rate, terms.inflation_base_year)
        * F.lit(terms.expense_share)
    )


def premium_cells(
    premium: DataFrame, terms: GroupTerms, months: str | Sequence[str] | None = None
) -> DataFrame:
    """Ceded premium and commission, and the expenses if they count premium rows."""
    types = [*fixed.PREMIUM_TYPES, fixed.COMMISSION_TYPE]
    totals = (
        _of_groups(premium, terms, month_list(months))
        .groupBy(*KEYS)
        .agg(
            *[(F.sum(t) * F.lit(terms.share)).alias(t) for t in types],
            F.count("*").alias("n"),
        )
    )
    if not terms.expenses_from_premium:
        return _long(totals, types)
    totals = totals.withColumns({"issue": _issue_cost(terms), "admin": _admin_cost(terms)})
    return _long(totals, [*types, "issue", "admin"])


def withdrawal_cells(
    withdrawals: DataFrame, terms: GroupTerms, months: str | Sequence[str] | None = None
) -> DataFrame:
    """The ceded sum of each withdrawal type."""
    return (
        _of_groups(withdrawals, terms, month_list(months))
        .filter(F.col("withdrawal_type").isin(list(fixed.WITHDRAWAL_TYPES)))
        .groupBy(*KEYS, F.col("withdrawal_type").alias("type"))
        .agg((F.sum("withdrawal_amount") * F.lit(terms.share)).cast("double").alias("total"))
    )


def snapshot_cells(
    snapshot: DataFrame, terms: GroupTerms, months: str | Sequence[str] | None = None
) -> DataFrame:
    """Reserves, interest and policy deductions, and the admin expense of policies.

    A policy whose interest or bonus is NULL adds nothing to the interest.
    """
    totals = (
        _of_groups(snapshot, terms, month_list(months))
        .groupBy(*KEYS)
        .agg(
            F.sum("stat_reserve").alias("reserves"),
            F.sum(F.col("interest_credited") + F.col("bonus_credited")).alias("interest"),
            F.sum("expense_charges").alias("policy_deduction"),
            F.count("*").alias("n"),
        )
    )
    types = ["reserves", "interest", "policy_deduction"]
    totals = totals.withColumns({t: F.col(t) * F.lit(terms.share) for t in types})
    if terms.expenses_from_premium:
        return _long(totals, types)
    return _long(totals.withColumn("admin", _admin_cost(terms)), [*types, "admin"])


def issue_cells(
    snapshot: DataFrame, terms: GroupTerms, months: str | Sequence[str] | None = None
) -> DataFrame:
    """Issue expense of new policies; new means new to the block, not the group."""
    counted = count_new_policies(snapshot, month_list(months), ["plangroup"])
    return counted.filter(F.col("plangroup").isin(list(terms.plan_groups))).select(
        *KEYS, F.lit("issue").alias("type"), _issue_cost(terms).alias("total")
    )


def report_lines(terms: GroupTerms) -> list[Line]:
    """The lines in report order: by section, then plan group, then type."""
    sections = [
        fixed.PREMIUM_TYPES,
        fixed.WITHDRAWAL_TYPES,
        (fixed.COMMISSION_TYPE,),
        ("issue",),
        ("admin",),
        ("reserves",),
        ("interest",),
        ("policy_deduction",),
    ]
    if terms.issue_lines_first:
        sections.insert(0, ("issue",))
    return [
        Line(
            cell=f"{group}/{kind}",
            labels={"plan_group": group, "type": kind},
            empty=0.0 if kind in ("issue", "admin") else None,
        )
        for section in sections
        for group in terms.plan_groups
        for kind in section
    ]


def group_reconciliation(
    snapshot: DataFrame,
    premium: DataFrame,
    withdrawals: DataFrame,
    terms: GroupTerms,
    months: str | Sequence[str] | None = None,
) -> DataFrame:
    """All lines (set_month, line_no, plan_group, type, total) of the given months."""
    months = month_list(months)
    parts = [
        premium_cells(premium, terms, months),
        withdrawal_cells(withdrawals, terms, months),
        snapshot_cells(snapshot, terms, months),
    ]
    if not terms.expenses_from_premium:
        parts.append(issue_cells(snapshot, terms, months))
    cells = reduce(DataFrame.unionByName, parts).withColumn(
        "cell", F.concat_ws("/", "plangroup", "type")
    )
    return complete(cells, report_lines(terms), months)
