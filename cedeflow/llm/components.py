"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedeflow.llm.storage import written

MAX_ROUNDS = 200


def _hung_on_least(directed: DataFrame, keep) -> DataFrame:
    """Each kept neighbour ``v`` of a node ``u``, hung on u's least neighbour."""
    least = directed.groupBy("u").agg(F.min("v").alias("least"))
    return (
        directed.join(least, "u")
        .withColumn("least", F.least("u", "least"))
        .filter(keep)
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
    )


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """One row ``node, component`` for every node with an edge to another.

    ``component`` is the least node reachable. Edges may repeat, point either
    way, or be loops; an edge with a null end is ignored. An empty table gives
    an empty one.

    Large-star and small-star steps alternate until the edges are stars round
    the least node of each component. A step is a pre-aggregated minimum and a
    join, its edges never outnumber those given, and no component is gathered
    in one task. Each round is written to the shared folder.
    """
    stars = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _hung_on_least(both, F.col("v") > F.col("u")).filter(F.col("u") != F.col("v")).distinct()
        )
        small = (
            _hung_on_least(large, F.lit(True))
            .union(large.groupBy("u").agg(F.min("v").alias("v")))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        stars = written(small)
        state = stars.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
        ).first()
        if state == seen:
            roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        seen = state
    raise RuntimeError("the components did not settle")
