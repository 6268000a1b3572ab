"""In-force and new-issue counts by month and report year.

In force counts distinct policies with a positive value in the month.  A
policy is newly issued in the first month it appears.  Rows exist only where
something is in force: new issues of a month and year without in-force
policies are not reported.

The wide part of every report is one grouping of the snapshot by policy, which
holds the distinct months, with and without value.  Both counts come from that,
so a snapshot is read and shuffled once, and a policy with many rows per month
is reduced before the shuffle.  A month is any text: those that are no calendar
months are reported like others, and a NULL month has its in-force count and no
new issues.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cedeflow import fixed_values as fixed
from cedeflow.functions.months import year_of
from cedeflow.operators.absence import not_in_as_of

MONTH = "set_month"


def _months_of(
    rows: DataFrame, policy: str, by: Sequence[str], in_force: Column
) -> DataFrame:
    """(policy, *by, months): the distinct months of each, with and without value.

    The set holds two entries a month at most, however many rows a policy has.
    """
    live = F.coalesce(in_force, F.lit(False)).alias("live")
    return rows.groupBy(F.col(policy).alias("policy"), *by).agg(
        F.collect_set(F.struct(F.col(MONTH).alias("month"), live)).alias("months")
    )


def _counts(months: DataFrame, by: Sequence[str]) -> DataFrame:
    """In-force policies and new issues per month, where there is either.

    A policy and ``by`` is new in its first month.  A NULL month, year or group
    has no new issues.
    """
    first = F.array_min(F.transform("months", lambda m: m["month"]))
    cells = F.array_append(
        F.transform(
            F.filter("months", lambda m: m["live"]),
            lambda m: F.struct(m["month"].alias("month"), F.lit(True).alias("live"), F.lit(False).alias("new")),
        ),
        F.struct(first.alias("month"), F.lit(False).alias("live"), F.lit(True).alias("new")),
    )
    known = F.col("policy").isNotNull()
    counts = (
        months.select("policy", *by, F.inline(cells))
        .groupBy(F.col("month").alias(MONTH), *by)
        .agg(
            F.count_if(F.col("live") & known).alias("ct_inforce"),
            F.max("live").alias("any_live"),
            F.count_if(F.col("new") & known).alias("issued"),
        )
    )
    complete = F.lit(True)
    for name in (MONTH, *by):
        complete = complete & F.col(name).isNotNull()
    issued = F.when(complete, F.col("issued")).otherwise(F.lit(0))
    return counts.select(MONTH, *by, "ct_inforce", "any_live", issued.alias("new_issued_policies"))


def _in_force_counts(months: DataFrame, by: Sequence[str]) -> DataFrame:
    return _counts(months, by).filter("any_live").drop("any_live")


def _with_new_issues(in_force: DataFrame, new_issues: DataFrame, by: Sequence[str]) -> DataFrame:
    """Both are a few rows per month.  A NULL year or group matches nothing."""
    return in_force.join(new_issues, [MONTH, *by], "left").select(
        MONTH,
        *by,
        "ct_inforce",
        F.coalesce("new_issued_policies", F.lit(0)).alias("new_issued_policies"),
    )


def cohorts_single(
    snapshot: DataFrame,
    policy: str = "policy_number",
    value: str = "gross_account_value",
    by: Sequence[str] = (),
) -> DataFrame:
    """Cohorts of a snapshot that carries its own ``reported_date``.

    ``by`` adds group columns such as the plan group.  A policy with two report
    years is newly issued once in each.
    """
    rows = snapshot.withColumn("report_year", year_of(F.col("reported_date")))
    keys = [*by, "report_year"]
    return _in_force_counts(_months_of(rows, policy, keys, F.col(value) > 0), keys)


def cohorts_policy(
    snapshot: DataFrame,
    policies: DataFrame,
    policy: str = "policy_number",
    value: str = "fund_value",
) -> DataFrame:
    """Cohorts of a snapshot whose report year is in a policy master."""
    years = policies.select(
        F.col(policy).alias("policy"), year_of(F.col("reported_date")).alias("report_year")
    ).distinct()
    months = _months_of(snapshot, policy, [], F.col(value) > 0).join(years, "policy")
    return _in_force_counts(months, ["report_year"])


def fitting(policy: Column, prefixes: Sequence[str]) -> Column:
    """The prefixes, as ``LIKE`` patterns, that a policy number fits: each of them."""
    return F.array_compact(F.array(*(F.when(policy.like(p), F.lit(p)) for p in prefixes)))


def cohorts_monthly_policy(
    snapshot: DataFrame,
    policies: DataFrame,
    prefix: str | Sequence[str] = "%",
    policy: str = "policynumber",
    strategy: str = "creditstrategy",
    value: str = "totalpolicyav",
) -> DataFrame:
    """Cohorts of policy numbers like ``prefix``, with policy rows per month.

    The master gives the report year of each month and strategy; a policy is
    new in its first master month, under its smallest report year.  The report
    year is an integer.

    Several prefixes are reported side by side, told apart by the column
    ``prefix``: both tables are read and joined once, and a policy counts for
    every prefix that it fits.
    """
    several = not isinstance(prefix, str)
    prefixes = list(dict.fromkeys(prefix)) if several else [prefix]
    fits = F.size(fitting(F.col(policy), prefixes)) > 0
    keys = [policy, MONTH, strategy]
    by = ["prefix", "report_year"]
    year = year_of(F.col("reported_date"))
    master = policies.filter(fits)
    live = snapshot.filter(fits & (F.col(value) > 0)).select(*keys).distinct()
    years = master.select(*keys, year.alias("report_year")).distinct()
    in_force = (
        live.join(years, keys)
        .select(policy, MONTH, "report_year")
        .distinct()
        .withColumn("prefix", F.explode(fitting(F.col(policy), prefixes)))
        .groupBy(MONTH, *by)
        .agg(F.count(F.lit(1)).alias("ct_inforce"))
        .withColumn("report_year", F.col("report_year").cast("int"))
    )
    new_issues = (
        master.groupBy(policy)
        .agg(F.min(MONTH).alias(MONTH), F.min(year.cast("int")).alias("report_year"))
        .withColumn("prefix", F.explode(fitting(F.col(policy), prefixes)))
        .groupBy(MONTH, *by)
        .agg(F.count(F.lit(1)).alias("new_issued_policies"))
    )
    both = _with_new_issues(in_force, new_issues, by)
    return both if several else both.drop("prefix")


def active_not_surrendered(
    snapshot: DataFrame,
    surrenders: DataFrame,
    policy: str = "mpolicy",
    surrendered_policy: str = "policy_number",
) -> DataFrame:
    """Active rows not surrendered by their month, counted as ``n``.

    Grouped by (policy, set_month, report_year, is_new); ``is_new`` marks rows
    reported in the month itself.
    """
    active = (
        snapshot.filter(F.col("current_status") == fixed.ACTIVE)
        .groupBy(
            policy,
            MONTH,
            year_of(F.col("reported_date")).alias("report_year"),
            F.coalesce(F.col("reported_date") == F.col(MONTH), F.lit(False)).alias("is_new"),
        )
        .agg(F.count("*").alias("n"))
    )
    return not_in_as_of(active, surrenders, policy, MONTH, listed_key=surrendered_policy)


def cohorts_migration(
    new_system: DataFrame,
    old_system: DataFrame,
    surrenders: DataFrame,
    cut_over: str = fixed.CUT_OVER_MONTH,
) -> DataFrame:
    """Cohorts of a block that moved to a new system in the cut-over month.

    Before the cut-over the old system is reported by value.  The new system is
    reported by status and surrenders, in rows rather than distinct policies;
    in the cut-over month itself new issues are the rows reported that month,
    in all its other months the policies first seen then.
    """
    by = ["report_year"]
    n, is_cut_over = F.col("n"), F.col(MONTH) == cut_over
    in_force = (
        active_not_surrendered(new_system, surrenders)
        .groupBy(MONTH, *by)
        .agg(
            F.sum(F.when(is_cut_over | F.col("mpolicy").isNotNull(), n).otherwise(0)).alias(
                "ct_inforce"
            ),
            F.sum(F.when(F.col("is_new"), n).otherwise(0)).alias("reported_now"),
        )
    )
    rows = new_system.withColumn("report_year", year_of(F.col("reported_date")))
    first_seen = _counts(_months_of(rows, "mpolicy", by, F.lit(False)), by).drop(
        "ct_inforce", "any_live"
    )
    new_part = in_force.join(first_seen, [MONTH, *by], "left").select(
        MONTH,
        *by,
        "ct_inforce",
        F.when(is_cut_over, F.col("reported_now"))
        .otherwise(F.coalesce("new_issued_policies", F.lit(0)))
        .alias("new_issued_policies"),
    )
    # a first month before the cut-over is the first of all months
    old_part = cohorts_single(old_system.filter(F.col(MONTH) < cut_over))
    return new_part.unionByName(old_part)
