"""Policy movements: one long frame from the tables of all kinds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedeflow.functions.factors import quota_share


def tag_movements(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All movement tables as (policy_number, set_month, kind, amount, reins_code).

    The premium table carries ``premium_amount``, all others
    ``withdrawal_amount``.
    """
    tagged = []
    for kind, table in tables.items():
        amount = "premium_amount" if kind == "premium" else "withdrawal_amount"
        tagged.append(
            table.select(
                "policy_number",
                "set_month",
                F.lit(kind).alias("kind"),
                F.col(amount).alias("amount"),
                "reins_code",
            )
        )
    return reduce(DataFrame.unionByName, tagged)


def amounts_by_kind(
    movements: DataFrame, kinds: Mapping[str, str], keys: Sequence[str]
) -> DataFrame:
    """One row per key with the summed amount of each kind in a column of its own."""
    wanted = movements.filter(F.col("kind").isin(list(kinds)))
    return wanted.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col("kind") == kind, F.col("amount"))).alias(column)
            for kind, column in kinds.items()
        ]
    )


def ceded_by_kind(movements: DataFrame, policies: DataFrame) -> DataFrame:
    """Ceded amount per month and kind over policies in the policy master.

    Movements of unknown policies drop out and a policy listed twice counts
    twice, as joining the master would do.  Both sides are grouped by policy
    first: the join then sees each policy once, however many rows it has.
    """
    summed = movements.groupBy("policy_number", "set_month", "kind", "reins_code").agg(
        F.sum("amount").alias("amount")
    )
    ceded = summed.withColumn("ceded", F.col("amount") * quota_share(F.col("reins_code")))
    copies = policies.groupBy("policy_number").agg(F.count("*").alias("copies"))
    return (
        ceded.join(copies, "policy_number")
        .groupBy("set_month", "kind")
        .agg(F.sum(F.col("ceded") * F.col("copies")).alias("ceded"))
    )
