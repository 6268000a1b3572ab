"""Policies of a month that the month before does not hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cedeflow.functions.months import (
    in_months,
    month_at,
    month_index,
    month_number,
    month_text,
    previous_month,
)

POLICY = "policy_number"
MONTH = "set_month"


def count_new_policies(
    snapshot: DataFrame, months: Sequence[str] | None, by: Sequence[str]
) -> DataFrame:
    """Snapshot rows ``n`` per month and ``by`` whose policy is new that month.

    New means ``NOT IN`` the policies of the calendar month before, whatever
    their ``by``, with SQL's NULL rules: without a month before all rows are
    new, a NULL policy there leaves none, and a NULL policy is never new to a
    month that has one before it.

    Rows meet their policy's months in one shuffle, by policy, or none if the
    snapshot is bucketed by it: a window that looks at exactly the month before
    tells who was absent there. All else follows from the counts of a month and
    ``by``, which are as few as the report's cells. Rows without a policy need
    no window; they are read by themselves, where files have any.
    """
    if months is not None:
        snapshot = in_months(snapshot, sorted({*months, *map(previous_month, months)}))
    rows = snapshot.select(POLICY, *by, month_index(month_number(F.col(MONTH))).alias("at"))
    rows = rows.filter(F.col("at").isNotNull())
    month_before = Window.partitionBy(POLICY).orderBy("at").rangeBetween(-1, -1)
    absent = F.count(F.lit(1)).over(month_before) == 0
    known = rows.filter(F.col(POLICY).isNotNull()).withColumn("absent", absent)
    nameless = rows.filter(F.col(POLICY).isNull()).withColumn("absent", F.lit(False))
    cells = (
        known.unionByName(nameless)
        .groupBy("at", *by)
        .agg(
            F.count(F.lit(1)).alias("n_all"),
            F.count_if("absent").alias("n_absent"),
            F.count_if(F.col(POLICY).isNull()).alias("n_nameless"),
        )
    )

    # A cell stands for its own month and, as the list, for the next.
    own = F.struct(*by, "n_all", "n_absent")
    nothing, none = F.lit(None).cast(cells.select(own.alias("own")).schema["own"].dataType), F.lit(0).cast("long")
    places = F.array(
        F.struct(F.col("at").alias("report"), own.alias("own"), none.alias("listed"), none.alias("nameless")),
        F.struct(
            (F.col("at") + 1).alias("report"),
            nothing.alias("own"),
            F.col("n_all").alias("listed"),
            F.col("n_nameless").alias("nameless"),
        ),
    )
    met = (
        cells.select(F.inline(places))
        .groupBy("report")
        .agg(
            F.collect_list("own").alias("cells"),
            F.sum("listed").alias("listed"),
            F.sum("nameless").alias("nameless"),
        )
    )
    if months is not None:
        met = met.filter(month_at(F.col("report")).isin([int(m) for m in months]))
    n = (
        F.when(F.col("listed") == 0, F.col("n_all"))
        .when(F.col("nameless") > 0, 0)
        .otherwise(F.col("n_absent"))
    )
    return (
        met.select("report", "listed", "nameless", F.inline("cells"))
        .select(month_text(month_at(F.col("report"))).alias(MONTH), *by, n.alias("n"))
        .filter("n > 0")
    )
