"""Report outputs as directories of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedeflow.operators.triangles import cohort_months, triangle_in_force, triangle_new


def write_monthly(
    report: DataFrame, path: str, sort: Sequence[str] = (), file_format: str = "parquet"
) -> None:
    """One directory per month; months already there are replaced, others kept.

    Without ``sort`` the rebalance hint lets Spark split a large month over
    several files and merge small ones.  ``sort`` orders the rows of a month:
    its files hold ranges that follow each other, and are sorted themselves.
    """
    if sort:
        by = ["set_month", *sort]
        rows = report.repartitionByRange(*by).sortWithinPartitions(*by)
    else:
        rows = report.hint("rebalance", F.col("set_month"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("set_month")
        .format(file_format)
        .save(path)
    )


def write_flat(
    report: DataFrame, path: str, sort: Sequence[str] = (), file_format: str = "csv"
) -> None:
    """The whole report as one dataset, in a total order if ``sort`` is given."""
    rows = report.orderBy(*sort) if sort else report
    rows.write.mode("overwrite").option("header", "true").format(file_format).save(path)


def write_sheets(
    path: str,
    cohorts: DataFrame,
    account_value: DataFrame | None = None,
    sort: Sequence[str] = ("set_month", "report_year"),
    file_format: str = "parquet",
) -> dict[str, DataFrame]:
    """The sheets Data, NB, IF and, if given, AV, a directory each under ``path``.

    The triangles are made from the written Data sheet, so the cohort counts
    are computed once.  Returns the sheets by name.
    """
    spark = cohorts.sparkSession
    data = f"{path}/Data"
    write_flat(cohorts, data, sort, file_format)
    written = (
        spark.read.format(file_format).schema(cohorts.schema).option("header", "true").load(data)
    )
    months = cohort_months(written)
    sheets = {"NB": triangle_new(written, months), "IF": triangle_in_force(written, months)}
    for name, triangle in sheets.items():
        write_flat(triangle, f"{path}/{name}", ["report_year"], file_format)
    if account_value is not None:
        write_flat(account_value, f"{path}/AV", ["set_month", "term"], file_format)
        sheets["AV"] = account_value
    return {"Data": written, **sheets}
