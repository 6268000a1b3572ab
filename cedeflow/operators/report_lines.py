"""Reports with a fixed list of lines, present even when no row fell into one."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Line:
    """A report line: the cell it shows, its labels, and its total when empty."""

    cell: str
    labels: Mapping[str, str] = field(default_factory=dict)
    empty: float | None = None


def complete(
    cells: DataFrame, lines: Sequence[Line], months: Sequence[str] | None, total: str = "total"
) -> DataFrame:
    """Every line for every month, in order, from cells (set_month, cell, total).

    The lines of one report are few, so each month's cells fit in one map; a
    cell may fill several lines.  Without given months, those found in the
    cells are reported.
    """
    spark = cells.sparkSession
    cells = cells.select("set_month", "cell", F.col("total").cast("double").alias("total"))
    cells = cells.filter(F.col("cell").isin(sorted({line.cell for line in lines})))
    if months is not None:
        asked = spark.range(0, 1, 1, 1).select(
            F.explode(F.array(*[F.lit(m) for m in months])).alias("set_month")
        )
        cells = cells.unionByName(asked, allowMissingColumns=True)
    by_month = (
        cells.groupBy("set_month")
        .agg(
            F.map_from_entries(
                F.collect_list(
                    F.when(F.col("cell").isNotNull(), F.struct("cell", "total"))
                )
            ).alias("totals")
        )
    )
    names = list(lines[0].labels)
    written = json.dumps(
        [
            {"line_no": number, "cell": line.cell, "empty": line.empty, **line.labels}
            for number, line in enumerate(lines, start=1)
        ]
    )
    fields = ["line_no:int", "cell:string", "empty:double", *[f"{name}:string" for name in names]]
    listed = F.from_json(F.lit(written), f"array<struct<{','.join(fields)}>>")
    rows = by_month.select("set_month", "totals", F.explode(listed).alias("line"))
    return rows.select(
        "set_month",
        "line.line_no",
        *[f"line.{name}" for name in names],
        F.coalesce(F.element_at("totals", F.col("line.cell")), F.col("line.empty")).alias(total),
    )
