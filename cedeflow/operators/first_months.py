"""Cohorts month by month from a kept state instead of all history.

The state holds a row for each policy and group: its first month, its last
month and whether it had a value then.  It is stored as of each month in a
``PolicyStore``, so a run reads the month's snapshot rows and the state as of
the month before, and never history.  A month that is run again starts from the
same earlier state: the second run takes the place of the first, also where the
snapshot has been corrected meanwhile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedeflow.functions.months import check_month, year_of
from cedeflow.sources.policy_store import MONTH, POLICY, PolicyStore

KIND = "first_months"


def _seen(rows: DataFrame, month: str, value: str, by: Sequence[str]) -> DataFrame:
    """The month's policies by group, with whether they have a value."""
    years = rows.filter(F.col(MONTH) == month).withColumn(
        "report_year", year_of(F.col("reported_date"))
    )
    live = F.coalesce(F.max(F.col(value) > 0), F.lit(False))
    return years.groupBy(POLICY, *by, "report_year").agg(live.alias("live"))


class FirstMonths:
    """The state of one block; ``by`` adds group columns such as the plan group."""

    def __init__(self, store: PolicyStore, by: Sequence[str] = (), kept_months: int = 2):
        if kept_months < 2:
            raise ValueError("a month run again needs the state of the month before")
        self.store, self.by, self.kept_months = store, list(by), kept_months
        self.keys = [*by, "report_year"]

    def as_of(self, month: str) -> DataFrame:
        """(policy_number, *by, report_year, first_month, last_month, live) as of a month."""
        return self.store.table(KIND).filter(F.col(MONTH) == month).drop(MONTH)

    def _before(self, month: str) -> DataFrame | None:
        stored = self.store.months(KIND) if self.store.has(KIND) else []
        if stored and month < stored[-1] and month not in stored[1:]:
            raise ValueError(f"the state before {month} is no longer kept; it begins with {stored[0]}")
        earlier = [m for m in stored if m < month]
        return self.as_of(earlier[-1]) if earlier else None

    def merge(self, rows: DataFrame, month: str, value: str = "gross_account_value") -> None:
        """Brings a month's snapshot rows into the state.

        Merge months in order.  After a rerun of an earlier month merge those
        after it again, as long as the state before them is kept.
        """
        check_month(month)
        before = self._before(month)
        state = (
            _seen(rows, month, value, self.by)
            .filter(F.col(POLICY).isNotNull())
            .withColumns({"first_month": F.lit(month), "last_month": F.lit(month)})
        )
        if before is not None:
            state = (
                state.unionByName(before)
                .groupBy(POLICY, *self.keys)
                .agg(
                    F.min("first_month").alias("first_month"),
                    F.max_by("live", "last_month").alias("live"),
                    F.max("last_month").alias("last_month"),
                )
            )
        self.store.replace_months(KIND, state.withColumn(MONTH, F.lit(month)))
        for old in self.store.months(KIND)[: -self.kept_months]:
            self.store.drop_month(KIND, old)

    def cohorts(self, rows: DataFrame, month: str, value: str = "gross_account_value") -> DataFrame:
        """The cohorts of a merged month, as ``cohorts_single`` reports them."""
        in_force = (
            _seen(rows, month, value, self.by)
            .groupBy(*self.keys)
            .agg(
                F.count_if(F.col("live") & F.col(POLICY).isNotNull()).alias("ct_inforce"),
                F.max("live").alias("any_live"),
            )
            .filter("any_live")
        )
        new = (
            self.as_of(month)
            .filter(F.col("first_month") == month)
            .groupBy(*self.keys)
            .agg(F.count(F.lit(1)).alias("issued"))
        )
        # a few rows a month; a NULL year or group has no new issues
        return in_force.join(new, self.keys, "left").select(
            F.lit(month).alias(MONTH),
            *self.keys,
            "ct_inforce",
            F.coalesce("issued", F.lit(0)).alias("new_issued_policies"),
        )
