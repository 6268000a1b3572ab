"""Report year by month triangles of cohort counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cohort_months(cohorts: DataFrame) -> list[str]:
    """The months of a cohort report; one short row per calendar month."""
    rows = (
        cohorts.filter(F.col("report_year").isNotNull() & F.col("set_month").isNotNull())
        .select("set_month")
        .distinct()
        .collect()
    )
    return sorted(row["set_month"] for row in rows)


def triangle(cohorts: DataFrame, value: str, months: Sequence[str] | None = None) -> DataFrame:
    """The sum of ``value`` with a row per report year and a column per month.

    Empty cells are 0 and rows without a report year are left out.  Without
    given months the report is read once more to find them, so pass a written
    report or the months.
    """
    months = cohort_months(cohorts) if months is None else list(months)
    return (
        cohorts.filter(F.col("report_year").isNotNull())
        .groupBy("report_year")
        .pivot("set_month", months)
        .agg(F.sum(value))
        .na.fill(0)
    )


def triangle_new(cohorts: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    return triangle(cohorts, "new_issued_policies", months)


def triangle_in_force(cohorts: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    return triangle(cohorts, "ct_inforce", months)
