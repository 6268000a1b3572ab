"""A block's tables laid out by policy, so that monthly runs need no shuffle.

A store holds catalog tables ``<name>_<kind>``, all bucketed and sorted by
policy into the same number of buckets.  Tables per month are partitioned by
month as well: a run of one month reads two month directories of the snapshot,
and each task has all rows of its policies.  Writing a month shuffles that
month; history stays where it is.

Take at least ``spark.sql.shuffle.partitions`` buckets, else Spark prefers to
shuffle into that many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cedeflow.functions.months import check_month

POLICY = "policy_number"
MONTH = "set_month"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


class PolicyStore:
    def __init__(self, spark: SparkSession, name: str, buckets: int):
        self.spark, self.name, self.buckets = spark, name, buckets

    def table_name(self, kind: str) -> str:
        return f"{self.name}_{kind}"

    def table(self, kind: str) -> DataFrame:
        return self.spark.table(self.table_name(kind))

    def has(self, kind: str) -> bool:
        return self.spark.catalog.tableExists(self.table_name(kind))

    def _create(self, kind: str, rows: DataFrame, partitions: list[str], mode: str) -> None:
        (
            rows.repartition(self.buckets, POLICY)
            .write.mode(mode)
            .format("parquet")
            .partitionBy(*partitions)
            .bucketBy(self.buckets, POLICY)
            .sortBy(POLICY)
            .saveAsTable(self.table_name(kind))
        )

    def replace_all(self, kind: str, rows: DataFrame) -> None:
        """Writes a table without months, such as the policy master."""
        self._create(kind, rows, [], "overwrite")

    def replace_months(self, kind: str, rows: DataFrame) -> None:
        """Writes the months that ``rows`` holds, in place of what they held.

        Other months stay.  Rows without a month are not stored.
        """
        rows = rows.filter(F.col(MONTH).isNotNull())
        if not self.has(kind):
            self._create(kind, rows, [MONTH], "errorifexists")
            return
        if self.spark.conf.get(OVERWRITE).lower() != "dynamic":
            raise ValueError(f"set {OVERWRITE} to dynamic, or other months would be lost")
        columns = self.table(kind).columns
        rows.select(*columns).repartition(self.buckets, POLICY).write.insertInto(
            self.table_name(kind), overwrite=True
        )

    def months(self, kind: str) -> list[str]:
        """The stored months in order, from the catalog: no data is read."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.table_name(kind)}").collect()
        return sorted(check_month(row.partition.partition("=")[2]) for row in listed)

    def last_month(self, kind: str = "snapshot") -> str | None:
        months = self.months(kind)
        return months[-1] if months else None

    def drop_month(self, kind: str, month: str) -> None:
        table = self.table_name(kind)
        self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({MONTH} = '{check_month(month)}')")

    def drop(self, kind: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table_name(kind)}")
