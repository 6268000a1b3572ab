"""Cash-flow and expense reconciliation of a treaty by reinsurance flag.

Inputs: ``snapshot`` (policy_number, set_month, reins_flag), ``policies``
(policy_number), ``premium`` (set_month, premium_amount, quota_share),
``commissions`` (set_month, reins_flag, paid) and ``movements`` as built by
``tag_movements`` from the ten movement tables, premium included.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedeflow import fixed_values as fixed
from cedeflow.functions.factors import claim_load, issue_load, quota_share
from cedeflow.functions.months import in_months, month_list
from cedeflow.operators.movements import ceded_by_kind
from cedeflow.operators.new_policies import count_new_policies
from cedeflow.operators.report_lines import Line, complete

CLAIM_COSTS = {
    "full_surrenders": ("surrender_expense", fixed.SURRENDER_COST),
    "death_claims": ("death_claim_expense", fixed.DEATH_CLAIM_COST),
}


def issue_expense(snapshot: DataFrame, months: str | Sequence[str] | None = None) -> DataFrame:
    """New policies counted by flag, weighted by the flag's share and load."""
    counted = count_new_policies(snapshot, month_list(months), ["reins_flag"])
    flag = F.col("reins_flag")
    cost = fixed.ISSUE_COST * F.col("n") * quota_share(flag) * issue_load(flag)
    return (
        counted.groupBy("set_month")
        .agg(F.sum(cost).alias("total"))
        .select("set_month", F.lit("issue_expense").alias("cell"), "total")
    )


def claim_expenses(movements: DataFrame, months: str | Sequence[str] | None = None) -> DataFrame:
    """Distinct surrendered and deceased policies by code, at a cost per policy."""
    claims = in_months(movements, month_list(months)).filter(F.col("kind").isin(list(CLAIM_COSTS)))
    counted = claims.groupBy("set_month", "kind", "reins_code").agg(
        F.count_distinct("policy_number").alias("n")
    )
    cell, cost = F.lit(None), F.lit(None)
    for kind, (name, amount) in CLAIM_COSTS.items():
        cell = F.when(F.col("kind") == kind, name).otherwise(cell)
        cost = F.when(F.col("kind") == kind, amount).otherwise(cost)
    code = F.col("reins_code")
    weighted = F.col("n") * cost * quota_share(code) * claim_load(code)
    return counted.groupBy("set_month", cell.alias("cell")).agg(F.sum(weighted).alias("total"))


def premium_allowances(premium: DataFrame, months: str | Sequence[str] | None = None) -> DataFrame:
    """Marketing expense and ceding allowance, both rates of the ceded premium."""
    ceded = (
        in_months(premium, month_list(months))
        .groupBy("set_month")
        .agg(F.sum(F.col("premium_amount") * F.col("quota_share")).alias("ceded"))
    )
    amount = F.col("ceded")
    return ceded.select(
        "set_month",
        F.abs(amount * F.lit(fixed.MARKETING_RATE)).cast("double").alias("marketing_expense"),
        (F.abs(amount * F.lit(fixed.CEDING_RATE)) / fixed.CEDING_DIVISOR)
        .cast("double")
        .alias("additional/ceding_allowance"),
    ).unpivot(
        ["set_month"], ["marketing_expense", "additional/ceding_allowance"], "cell", "total"
    )


def movement_totals(
    movements: DataFrame, policies: DataFrame, months: str | Sequence[str] | None = None
) -> DataFrame:
    """The ceded amount of each movement kind."""
    ceded = ceded_by_kind(in_months(movements, month_list(months)), policies)
    return ceded.select("set_month", F.col("kind").alias("cell"), F.col("ceded").alias("total"))


def commission(commissions: DataFrame, months: str | Sequence[str] | None = None) -> DataFrame:
    """The ceded commission."""
    by_flag = (
        in_months(commissions, month_list(months))
        .groupBy("set_month", "reins_flag")
        .agg(F.sum("paid").alias("paid"))
    )
    return (
        by_flag.groupBy("set_month")
        .agg(F.sum(F.col("paid") * quota_share(F.col("reins_flag"))).alias("total"))
        .select("set_month", F.lit("commission").alias("cell"), "total")
    )


def report_lines() -> list[Line]:
    names = [*fixed.TREATY_EXPENSES, *fixed.TREATY_MOVEMENTS, "commission"]
    return [Line(cell=name, labels={"fieldname": name}) for name in names]


def treaty_reconciliation(
    snapshot: DataFrame,
    policies: DataFrame,
    movements: DataFrame,
    premium: DataFrame,
    commissions: DataFrame,
    months: str | Sequence[str] | None = None,
) -> DataFrame:
    """The sixteen lines (set_month, line_no, fieldname, withdrawal_amount) per month."""
    months = month_list(months)
    parts = [
        issue_expense(snapshot, months),
        premium_allowances(premium, months),
        claim_expenses(movements, months),
        movement_totals(movements, policies, months),
        commission(commissions, months),
    ]
    as_double = [
        part.select("set_month", "cell", F.col("total").cast("double").alias("total"))
        for part in parts
    ]
    cells = reduce(DataFrame.unionByName, as_double)
    return complete(cells, report_lines(), months, total="withdrawal_amount")
