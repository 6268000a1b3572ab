"""Named input tables, from the catalog or from files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from cedeflow.operators.movements import tag_movements

MONTH = "set_month"
INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


class Tables:
    """The tables a block's reports may read, by their name in the report.

    A location with a slash is a directory or file of the given format; any
    other is a table of the session's catalog.  Only names listed here can be
    read, so a name taken from a parameter cannot reach another table.

    ``set_month`` is text in every table, also in a directory partitioned by it:
    its partition values are taken as they are written, leading zeros included,
    and a filter on them still prunes directories.
    """

    def __init__(
        self, spark: SparkSession, locations: Mapping[str, str], file_format: str = "parquet"
    ):
        self.spark = spark
        self.locations = dict(locations)
        self.file_format = file_format
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.locations:
            known = ", ".join(sorted(self.locations))
            raise KeyError(f"unknown table {name!r}; known tables: {known}")
        if name not in self._read:
            location = self.locations[name]
            frame = self._load(location) if "/" in location else self.spark.table(location)
            if dict(frame.dtypes).get(MONTH, "string") != "string":
                frame = frame.withColumn(MONTH, frame[MONTH].cast("string"))
            self._read[name] = frame
        return self._read[name]

    def _load(self, location: str) -> DataFrame:
        """The files of a directory, without guessing types of partition values."""
        before = self.spark.conf.get(INFERENCE)
        self.spark.conf.set(INFERENCE, "false")
        try:
            return self.spark.read.format(self.file_format).load(location)
        finally:
            self.spark.conf.set(INFERENCE, before)

    def check(self, needed: Mapping[str, Iterable[str]]) -> None:
        """An error that names every table and column of ``needed`` that is not there.

        Only schemas are read, so a report that lacks a column fails before it runs.
        """
        absent = []
        for name, columns in needed.items():
            if name not in self.locations:
                absent.append(f"table {name!r}")
                continue
            known = {column.lower() for column in self[name].columns}
            absent += [f"{name}.{column}" for column in columns if column.lower() not in known]
        if absent:
            raise ValueError(f"not in the tables: {', '.join(absent)}")

    def movements(self, kinds: Iterable[str]) -> DataFrame:
        """The movement tables of the given kinds as one long frame."""
        return tag_movements({kind: self[kind] for kind in kinds})
