"""``NOT IN`` with SQL's NULL rules, without Spark's all-broadcast plan for it.

Spark plans a literal ``NOT IN (sub-query)`` as a null-aware join that
broadcasts the whole list, and a correlated one as a nested loop.  Here the
NULL rules are decided from small facts about the list and the rest is an
ordinary anti join on the key.

A key that holds a large part of all rows is best grouped before it gets here:
the reports count rows per key first and filter the counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedeflow.functions.months import month_number


def not_in(rows: DataFrame, listed: DataFrame, key: str, month: str | None = None) -> DataFrame:
    """Rows whose key is not in the list.

    With ``month``, a column of both sides, each row is held against the part
    of the list that carries its month.  As in SQL an empty list keeps every
    row, a list with a NULL keeps none, and a NULL key is kept only by an empty
    list.
    """
    is_null = F.col(key).isNull()
    if month is None:
        state = (
            listed.agg(
                F.when(F.count("*") == 0, "empty")
                .when(F.count_if(is_null) > 0, "has null")
                .otherwise("complete")
                .alias("state")
            )
        ).scalar()
        open_rows = rows.filter((state == "empty") | (~is_null & (state == "complete")))
        return open_rows.join(listed.select(key).distinct(), key, "left_anti")

    # A row per month of the list, whatever its text; a NULL month has no list.
    facts = listed.groupBy(F.col(month).alias("list_month")).agg(
        (F.count_if(is_null) > 0).alias("list_has_null")
    )
    has_null = F.col("list_has_null")
    open_rows = (
        rows.join(facts, F.col(month) == F.col("list_month"), "left")
        .filter(has_null.isNull() | (~is_null & ~has_null))
        .drop("list_month", "list_has_null")
    )
    return open_rows.join(listed.select(key, month).distinct(), [key, month], "left_anti")


def not_in_as_of(
    rows: DataFrame,
    listed: DataFrame,
    key: str,
    month: str = "set_month",
    listed_key: str | None = None,
    listed_month: str = "set_month",
) -> DataFrame:
    """Rows whose key is not in the list up to and including the row's month.

    A key leaves from its first listed month on.  A NULL in the list takes all
    rows from its month on, and a NULL key is kept only before the list begins.
    """
    listed = listed.select(
        F.col(listed_key or key).alias("listed_key"),
        month_number(F.col(listed_month)).alias("listed_from"),
    )
    facts = listed.agg(
        F.struct(
            F.min("listed_from").alias("any"),
            F.min(F.when(F.col("listed_key").isNull(), F.col("listed_from"))).alias("null"),
        )
    ).scalar()
    first_any, first_null = facts["any"], facts["null"]
    first_by_key = (
        listed.filter(F.col("listed_key").isNotNull())
        .groupBy("listed_key")
        .agg(F.min("listed_from").alias("listed_from"))
    )
    now = month_number(F.col(month))
    open_rows = rows.filter(first_null.isNull() | (now < first_null)).filter(
        F.col(key).isNotNull() | first_any.isNull() | (now < first_any)
    )
    gone = (F.col(key) == F.col("listed_key")) & (F.col("listed_from") <= now)
    return open_rows.join(first_by_key, gone, "left_anti")
