"""Account-value roll-forward of a block from one month end to the next.

Inputs: ``snapshot`` (policy_number, set_month, reins_flag, val_code,
purchase_price, interest_earned, fund_value, stat_reserve), ``policies``
(policy_number, date_issued) and ``movements`` as built by ``tag_movements``.

The report covers the given months, or without any every calendar month from
the first snapshot to the last, in a single pass: the snapshot is shuffled once
by policy and sorted by month.  A snapshot row is the end of its own month and
the beginning of the next, and one window, which looks from each row at its own
month and at exactly the next one, finds what it has there.  No row is doubled
for that.  Movements and the policy master join on the same partitioning; from
tables that are bucketed by policy nothing is shuffled at all.

A policy has one snapshot row per month, which bounds what one policy can
bring into a task; movements, which have no such bound, are summed per policy
and month before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cedeflow import fixed_values as fixed
from cedeflow.functions.factors import quota_share
from cedeflow.functions.months import (
    in_months,
    month_at,
    month_index,
    month_list,
    month_number,
    month_text,
    not_before,
    previous_month,
)
from cedeflow.operators.movements import amounts_by_kind

POLICY = "policy_number"
MONTH = "set_month"
# What a snapshot row is to the month it is reported for.
BEGINNING, ENDING = 0, 1
MOVEMENT_COLUMNS = tuple(fixed.ROLLFORWARD_MOVEMENTS.values())
COLUMNS = (
    MONTH,
    POLICY,
    "date_issued",
    "beginning_fund_value",
    "premium",
    "interest_earned",
    *MOVEMENT_COLUMNS,
    "end_fund_value",
    "qs",
    "beginning_reserve_stat",
    "end_reserve_stat",
    "new_policy_check",
    "val_code",
)


def _snapshot_values(snapshot: DataFrame, months: Sequence[str] | None) -> DataFrame:
    """The months asked for and those before them; purchase and interest ceded."""
    if months is not None:
        snapshot = in_months(snapshot, sorted({*months, *map(previous_month, months)}))
    share = quota_share(F.col("reins_flag"))
    held = F.struct(
        (F.col("purchase_price") * share).alias("purchase"),
        (F.col("interest_earned") * share).alias("interest"),
        F.col("fund_value").alias("fund"),
        F.col("stat_reserve").alias("reserve"),
        share.alias("share"),
        "val_code",
    )
    return snapshot.filter(F.col(POLICY).isNotNull()).select(
        POLICY, month_index(month_number(F.col(MONTH))).alias("at"), held.alias("held")
    )


def _moved_by_policy(movements: DataFrame, months: Sequence[str] | None) -> DataFrame:
    """(policy_number, moved): the summed movements of each month, by its index."""
    by_month = amounts_by_kind(
        in_months(movements, months), fixed.ROLLFORWARD_MOVEMENTS, [POLICY, MONTH]
    ).filter(F.col(POLICY).isNotNull() & F.col(MONTH).isNotNull())
    at = month_index(month_number(F.col(MONTH)))
    entry = F.struct(at.alias("at"), F.struct(*MOVEMENT_COLUMNS).alias("sums"))
    return by_month.groupBy(POLICY).agg(F.map_from_entries(F.collect_list(entry)).alias("moved"))


def _met(snapshot: DataFrame, movements: DataFrame, months: Sequence[str] | None) -> DataFrame:
    """Snapshot rows with what their policy has in their own and the next month.

    ``rows_now`` and ``moved_now`` are of the row's month, ``rows_next``,
    ``held_next`` and ``moved_next`` of the month after, and of no later one.
    """
    at = F.col("at")
    by_month = Window.partitionBy(POLICY).orderBy("at")
    now, following = by_month.rangeBetween(0, 0), by_month.rangeBetween(1, 1)
    return (
        _snapshot_values(snapshot, months)
        .withColumns(
            {
                "rows_now": F.count(F.lit(1)).over(now),
                "rows_next": F.count(F.lit(1)).over(following),
                "held_next": F.first("held").over(following),
            }
        )
        .join(_moved_by_policy(movements, months), POLICY, "left")
        .withColumns(
            {
                "moved_now": F.try_element_at("moved", at),
                "moved_next": F.try_element_at("moved", at + 1),
            }
        )
        .drop("moved")
    )


def _reported(
    at: Column, snapshot: DataFrame, months: Sequence[str] | None, last: str | Column | None
) -> Column:
    """Whether the month of that index is in the report."""
    if months is not None:
        return month_at(at).isin([int(m) for m in months])
    if last is None:
        last = snapshot.agg(F.max(month_number(F.col(MONTH)))).scalar()
    elif isinstance(last, str):
        last = F.lit(last)
    return month_at(at) <= last.cast("int")


def _or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0))


def _report(
    snapshot: DataFrame,
    policies: DataFrame,
    movements: DataFrame,
    months: str | Sequence[str] | None,
    last: str | Column | None,
    roles: Sequence[int],
) -> DataFrame:
    months = month_list(months)
    at = F.col("at")
    wanted = {
        BEGINNING: _reported(at + 1, snapshot, months, last),
        ENDING: not_before(F.col("date_issued"), month_at(at)),
    }
    if months is not None:
        wanted[ENDING] = wanted[ENDING] & _reported(at, snapshot, months, last)
    taken = F.array_compact(F.array(*(F.when(wanted[role], F.lit(role)) for role in roles)))
    rows = (
        _met(snapshot, movements, months)
        .join(policies.select(POLICY, "date_issued"), POLICY)
        .withColumn("role", F.explode(taken))
    )
    is_beginning = F.col("role") == BEGINNING
    share = F.col("held.share")
    endings = F.when(is_beginning, F.col("rows_next")).otherwise(F.col("rows_now"))
    two = F.raise_error(F.lit("a policy has more than one snapshot row in a month"))

    def end(name: str) -> Column:
        """An ending value; more than one ending row for the policy is an error."""
        value = F.when(is_beginning, F.col(f"held_next.{name}")).otherwise(F.col(f"held.{name}"))
        return F.when(endings > 1, two).otherwise(value)

    def moved(name: str) -> Column:
        amount = F.when(is_beginning, F.col(f"moved_next.{name}")).otherwise(F.col(f"moved_now.{name}"))
        return _or_zero(amount * share)

    def at_beginning(amount: Column) -> Column:
        return F.when(is_beginning, _or_zero(amount)).otherwise(F.lit(0))

    def gained(name: str) -> Column:
        before = F.col(f"held.{name}")
        return _or_zero(F.when(is_beginning, end(name) - before).otherwise(before))

    columns = {
        MONTH: month_text(month_at(F.when(is_beginning, at + 1).otherwise(at))),
        "beginning_fund_value": at_beginning(F.col("held.fund") * share),
        "premium": gained("purchase"),
        "interest_earned": gained("interest"),
        **{name: moved(name) for name in MOVEMENT_COLUMNS},
        "end_fund_value": _or_zero(end("fund") * share),
        "qs": share,
        "beginning_reserve_stat": at_beginning(F.col("held.reserve") * share),
        "end_reserve_stat": _or_zero(end("reserve") * share),
        "new_policy_check": F.when(is_beginning, "0").otherwise("1"),
        "val_code": end("val_code"),
    }
    return rows.select(*[columns.get(name, F.col(name)).alias(name) for name in COLUMNS])


def rollforward_existing(
    snapshot: DataFrame,
    policies: DataFrame,
    movements: DataFrame,
    months: str | Sequence[str] | None = None,
    last: str | Column | None = None,
) -> DataFrame:
    """Policies of last month's snapshot, with what became of them.

    Beginning and end value, end reserve and movements are ceded at the share
    of last month's flag; premium and interest compare each month's own share.
    """
    return _report(snapshot, policies, movements, months, last, [BEGINNING])


def rollforward_new(
    snapshot: DataFrame,
    policies: DataFrame,
    movements: DataFrame,
    months: str | Sequence[str] | None = None,
    last: str | Column | None = None,
) -> DataFrame:
    """Policies of the month's snapshot issued on or after its first day."""
    return _report(snapshot, policies, movements, months, last, [ENDING])


def rollforward(
    snapshot: DataFrame,
    policies: DataFrame,
    movements: DataFrame,
    months: str | Sequence[str] | None = None,
    last: str | Column | None = None,
) -> DataFrame:
    """Existing and new policies together; a policy can be in both parts.

    ``last`` is the last month of the snapshot, for a run of all months, where
    the caller knows it; else the snapshot's months are read once more.
    """
    return _report(snapshot, policies, movements, months, last, [BEGINNING, ENDING])


def with_checks(report: DataFrame) -> DataFrame:
    """Adds the expected end value and how far the reported one is from it."""
    counted = [F.col(name) for name in fixed.OUTFLOW_COLUMNS]
    return (
        report.withColumns(
            {
                "inflow": F.abs(F.col("premium") + F.col("interest_earned")),
                "outflow": F.abs(sum(counted[1:], counted[0])),
            }
        )
        .withColumn("exp_av", F.col("beginning_fund_value") + F.col("inflow") - F.col("outflow"))
        .withColumn("diff", F.col("end_fund_value") - F.col("exp_av"))
    )


def total_difference(checked: DataFrame) -> DataFrame:
    """The sum of absolute differences per month."""
    return checked.groupBy(MONTH).agg(F.sum(F.abs(F.col("diff"))).alias("sum_diff"))
