"""Every report over the whole of the sample tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from cedeflow import fixed_values as fixed
from cedeflow.functions.factors import claim_load, issue_load, quota_share
from cedeflow.functions.months import first_day_of, next_month_of, previous_month_of, year_of
from cedeflow.operators import account_value, cohorts, tranches, treaty_reconciliation
from cedeflow.operators.absence import not_in, not_in_as_of
from cedeflow.operators.group_reconciliation import (
    TERMS_50,
    TERMS_95,
    GroupTerms,
    group_reconciliation,
    issue_cells,
    premium_cells,
    snapshot_cells,
    withdrawal_cells,
)
from cedeflow.operators.movements import amounts_by_kind, tag_movements
from cedeflow.operators.rollforward import (
    rollforward,
    rollforward_existing,
    rollforward_new,
    total_difference,
    with_checks,
)
from cedeflow.operators.triangles import triangle_in_force, triangle_new
from cedeflow.samples.views import PLAN_GROUPS, SampleViews

CUT_OVER = "199806"
SINCE = "199701"
#: A January, so that the month before is in another year.
ONE_MONTH = "199801"
TRANCHES = (
    (1, None, date(1996, 12, 30)),
    (2, date(1997, 1, 1), date(1998, 6, 30)),
    (3, date(1998, 7, 1), date(1999, 12, 31)),
    (4, date(2000, 1, 1), date(2001, 3, 31)),
)

def _sample_terms(terms: GroupTerms) -> GroupTerms:
    return GroupTerms(**{**vars(terms), "plan_groups": PLAN_GROUPS})


SAMPLE_95 = _sample_terms(TERMS_95)
SAMPLE_50 = _sample_terms(TERMS_50)


def _plain(report: DataFrame) -> DataFrame:
    """Exact decimals as doubles, the last step of a report."""
    return report.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f"`{f.name}`")
            for f in report.schema.fields
        ]
    )


def _rounded(report: DataFrame) -> DataFrame:
    """Admin expense is a floating power, so its last digits are rounded off."""
    return report.withColumn("total", F.round("total", 6))


def _rollforward_inputs(v: SampleViews) -> tuple[DataFrame, DataFrame, DataFrame]:
    return v.snapshot(), v.policies(), v.movements()


def _all_months(v: SampleViews, report: Callable[..., DataFrame]) -> DataFrame:
    return report(*_rollforward_inputs(v), last=v.last_month())


def _checked(v: SampleViews) -> DataFrame:
    return with_checks(_all_months(v, rollforward))


def _group_inputs(v: SampleViews) -> tuple[DataFrame, DataFrame, DataFrame]:
    return v.snapshot(), v.group_premium(), v.group_withdrawals()


def _treaty(v: SampleViews, months: str | None = None) -> DataFrame:
    return treaty_reconciliation.treaty_reconciliation(
        v.snapshot(), v.policies(), v.all_movements(), v.premium(), v.commissions(), months
    )


def _cohorts_plan_group(v: SampleViews) -> DataFrame:
    return cohorts.cohorts_single(v.snapshot(), value="eom_fund_value", by=["plangroup"])


def _triangle(v: SampleViews, make: Callable[..., DataFrame]) -> DataFrame:
    """A column for every month of the years that the line items cover."""
    ends = v.lines().agg(F.min("set_month").alias("first"), F.max("set_month").alias("last")).first()
    years = range(int(ends.first[:4]), int(ends.last[:4]) + 1) if ends.first else ()
    months = [f"{year}{month:02d}" for year in years for month in range(1, 13)]
    return make(_cohorts_plan_group(v), months)


def _life_face(v: SampleViews) -> DataFrame:
    return tranches.life_face(v.life_snapshot(), v.life_annuities(), v.life_codes(), TRANCHES)


def _life_premium(v: SampleViews) -> DataFrame:
    return tranches.life_premium(v.life_premiums(), v.life_snapshot(), TRANCHES)


def _life_claims(v: SampleViews) -> DataFrame:
    return tranches.life_claims(v.life_claims(), TRANCHES)


def _previous_list(v: SampleViews) -> DataFrame:
    return v.snapshot().select(
        "policy_number", next_month_of(F.col("set_month")).alias("set_month")
    )


def _active_rows(v: SampleViews) -> DataFrame:
    rows = v.snapshot().filter(F.col("current_status") == fixed.ACTIVE)
    return rows.select("policy_number", "set_month", "fund_value")


def _active_counts(v: SampleViews) -> DataFrame:
    rows = cohorts.active_not_surrendered(v.new_system(), v.surrenders())
    return rows.groupBy("set_month", "report_year").agg(
        F.sum("n").alias("ct_active"),
        F.sum(F.when(F.col("is_new"), F.col("n")).otherwise(0)).alias("ct_reported"),
    )


def _movement_union(v: SampleViews) -> DataFrame:
    return (
        tag_movements(v.movement_tables())
        .groupBy("set_month", "kind")
        .agg(F.count("*").alias("ct"), F.sum("amount").alias("amount"))
    )


def _movements_wide(v: SampleViews) -> DataFrame:
    return amounts_by_kind(
        v.movements(), fixed.ROLLFORWARD_MOVEMENTS, ["policy_number", "set_month"]
    )


def _months(v: SampleViews) -> DataFrame:
    month = F.col("set_month")
    return (
        v.lines()
        .groupBy("set_month")
        .agg(F.count("*").alias("ct"))
        .select(
            "set_month",
            previous_month_of(month).alias("previous_month"),
            next_month_of(month).alias("next_month"),
            first_day_of(month).alias("first_day"),
            year_of(month).alias("year"),
            "ct",
        )
    )


def _rates(v: SampleViews) -> DataFrame:
    flag = F.col("reins_flag")
    return (
        v.snapshot()
        .groupBy("reins_flag")
        .agg(F.count("*").alias("ct"))
        .select(
            "reins_flag",
            quota_share(flag).alias("qs"),
            issue_load(flag).alias("issue_load"),
            claim_load(flag).alias("claim_load"),
            "ct",
        )
    )


REPORTS: dict[str, Callable[[SampleViews], DataFrame]] = {
    # roll-forward
    "rollforward_existing": lambda v: _all_months(v, rollforward_existing),
    "rollforward_new": lambda v: _all_months(v, rollforward_new),
    "rollforward_checked": _checked,
    "rollforward_difference": lambda v: total_difference(_checked(v)),
    "rollforward_one_month": lambda v: with_checks(
        rollforward(*_rollforward_inputs(v), months=ONE_MONTH)
    ),
    # plan-group reconciliation
    "group_reconciliation_95": lambda v: _rounded(
        group_reconciliation(*_group_inputs(v), SAMPLE_95)
    ),
    "group_reconciliation_50": lambda v: _rounded(
        group_reconciliation(*_group_inputs(v), SAMPLE_50)
    ),
    "group_reconciliation_one_month": lambda v: _rounded(
        group_reconciliation(*_group_inputs(v), SAMPLE_95, ONE_MONTH)
    ),
    "group_premium_cells": lambda v: premium_cells(v.group_premium(), SAMPLE_95),
    "group_withdrawal_cells": lambda v: withdrawal_cells(v.group_withdrawals(), SAMPLE_95),
    "group_snapshot_cells": lambda v: _rounded(snapshot_cells(v.snapshot(), SAMPLE_95)),
    "group_issue_cells": lambda v: issue_cells(v.snapshot(), SAMPLE_95),
    "group_premium_expense_cells": lambda v: _rounded(
        premium_cells(v.group_premium(), SAMPLE_50)
    ),
    # treaty reconciliation
    "treaty_reconciliation": _treaty,
    "treaty_reconciliation_one_month": lambda v: _treaty(v, ONE_MONTH),
    "treaty_movement_totals": lambda v: treaty_reconciliation.movement_totals(
        v.all_movements(), v.policies()
    ),
    "treaty_commission": lambda v: treaty_reconciliation.commission(v.commissions()),
    "treaty_issue_expense": lambda v: treaty_reconciliation.issue_expense(v.snapshot()),
    "treaty_premium_allowances": lambda v: treaty_reconciliation.premium_allowances(v.premium()),
    "treaty_claim_expenses": lambda v: treaty_reconciliation.claim_expenses(v.movements()),
    # cohorts
    "cohorts_monthly_policy": lambda v: cohorts.cohorts_monthly_policy(
        v.strategy_snapshot(), v.strategy_policies(), fixed.POLICY_PREFIXES
    ),
    "cohorts_policy": lambda v: cohorts.cohorts_policy(v.snapshot(), v.policies()),
    "cohorts_plan_group": _cohorts_plan_group,
    "cohorts_index": lambda v: cohorts.cohorts_single(v.index_snapshot(), policy="policy_id"),
    "cohorts_migration": lambda v: cohorts.cohorts_migration(
        v.new_system(), v.snapshot(), v.surrenders(), CUT_OVER
    ),
    "active_not_surrendered": _active_counts,
    "triangle_new": lambda v: _triangle(v, triangle_new),
    "triangle_in_force": lambda v: _triangle(v, triangle_in_force),
    # net account value
    "net_av_dedup": lambda v: account_value.net_av_dedup(
        v.strategy_snapshot(), v.strategy_policies(), fixed.POLICY_PREFIXES, SINCE
    ),
    "net_av_flat": lambda v: account_value.net_av_flat(v.snapshot()),
    "net_av_flag": lambda v: account_value.net_av_flag(v.snapshot(), v.terms(), SINCE),
    # life tranches
    "life_premium": _life_premium,
    "life_face": _life_face,
    "life_claims": _life_claims,
    "life_merged": lambda v: tranches.life_merged(
        _life_face(v), _life_premium(v), _life_claims(v)
    ),
    # building blocks
    "anti_join_null_aware": lambda v: not_in(
        _active_rows(v), _previous_list(v), "policy_number", "set_month"
    ),
    "anti_join_as_of": lambda v: not_in_as_of(_active_rows(v), v.surrenders(), "policy_number"),
    "movement_union": _movement_union,
    "movements_wide": _movements_wide,
    "month_arithmetic": _months,
    "rate_factors": _rates,
}


def _query(report: Callable[[SampleViews], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain(report(SampleViews(spark, sf_dir)))


QUERIES = {name: _query(report) for name, report in REPORTS.items()}
