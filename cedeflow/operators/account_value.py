"""Net account value by month, under flat, flag-dependent or per-row shares."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedeflow import fixed_values as fixed
from cedeflow.functions.factors import quota_share
from cedeflow.operators.cohorts import fitting


def net_av_flat(
    snapshot: DataFrame,
    share: Decimal = fixed.ACCOUNT_VALUE_SHARE,
    value: str = "eom_fund_value",
) -> DataFrame:
    """Policies and ceded value by month and term, at one share."""
    return snapshot.groupBy("set_month", "term").agg(
        F.count("policy_number").alias("ct"),
        F.sum(F.col(value) * F.lit(share)).alias("net_fund_value"),
    )


def net_av_flag(
    snapshot: DataFrame,
    terms: DataFrame,
    since: str = fixed.ACCOUNT_VALUE_SINCE,
    value: str = "fund_value",
) -> DataFrame:
    """Policies and ceded value by month and term, the term looked up by plan.

    The snapshot is summed by plan before the lookup, so the join sees one row
    per month and plan and no plan is too common for it.
    """
    by_plan = (
        snapshot.filter(F.col("set_month") >= since)
        .groupBy("set_month", "plan")
        .agg(
            F.count("policy_number").alias("ct"),
            F.sum(F.col(value) * quota_share(F.col("reins_flag"))).alias("net_fund_value"),
        )
    )
    return (
        by_plan.join(terms.select("plan", "term"), "plan")
        .groupBy("set_month", "term")
        .agg(F.sum("ct").alias("ct"), F.sum("net_fund_value").alias("net_fund_value"))
    )


def net_av_dedup(
    snapshot: DataFrame,
    policies: DataFrame,
    prefix: str | Sequence[str] = "%",
    since: str = fixed.ACCOUNT_VALUE_SINCE,
    policy: str = "policynumber",
    value: str = "totalpolicyav",
    share: str = "ceded_share",
) -> DataFrame:
    """Ceded value by month and plan over distinct policy, value, plan and share.

    Both sides are made distinct before the join: rows that differ only in
    other columns then cannot multiply, and the joined rows are distinct again.
    Several prefixes are reported side by side, as ``cohorts_monthly_policy``
    does, from one pass over each table.
    """
    several = not isinstance(prefix, str)
    prefixes = list(dict.fromkeys(prefix)) if several else [prefix]
    chosen = (F.size(fitting(F.col(policy), prefixes)) > 0) & (F.col("set_month") >= since)
    keys = [policy, "set_month"]
    values = snapshot.filter(chosen).select(*keys, value, share).distinct()
    plans = policies.filter(chosen).select(*keys, "plan").distinct()
    by_prefix = (
        values.join(plans, keys)
        .withColumn("prefix", F.explode(fitting(F.col(policy), prefixes)))
        .groupBy("set_month", "prefix", "plan")
        .agg(F.sum(F.col(value) * F.col(share)).alias("net_av"))
    )
    return by_prefix if several else by_prefix.drop("prefix")
