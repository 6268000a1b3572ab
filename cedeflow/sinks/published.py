"""Reports published as a whole: readers see all sheets of a run, or of the one before.

A run writes its sheets into a folder of its own.  Only then does it add one
row to the manifest, which is a single file that is there or not.  Readers
follow the manifest's last row.  A run that is lost on the way leaves a folder
that no manifest names, and the sheets of the run before stay what readers get.

One run publishes to a path at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "number long, folder string, file_format string, schemas map<string, string>"


def _manifest(path: str) -> str:
    return f"{path}/manifest"


def current(spark: SparkSession, path: str) -> Row | None:
    """The manifest's last row, or None before the first run."""
    try:
        rows = spark.read.schema(MANIFEST).json(_manifest(path))
        return rows.orderBy(F.desc("number")).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def publish(
    spark: SparkSession,
    path: str,
    write: Callable[[str], Mapping[str, DataFrame]],
    file_format: str = "parquet",
) -> str:
    """Publishes what ``write`` puts into the folder it is given; the folder's path.

    ``write`` returns the sheets by their place in the folder.
    """
    before = current(spark, path)
    number = before.number + 1 if before else 1
    folder = f"run_{number:06d}_{uuid.uuid4().hex}"
    sheets = write(f"{path}/{folder}")
    schemas = {name: sheet.schema.json() for name, sheet in sheets.items()}
    row = spark.createDataFrame([(number, folder, file_format, schemas)], MANIFEST)
    row.coalesce(1).write.mode("append").json(_manifest(path))
    return f"{path}/{folder}"


def published(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """A sheet of the last run that was published whole."""
    row = current(spark, path)
    if row is None or sheet not in row.schemas:
        known = ", ".join(sorted(row.schemas)) if row else "nothing is published"
        raise KeyError(f"no sheet {sheet!r} at {path}: {known}")
    schema = StructType.fromJson(json.loads(row.schemas[sheet]))
    reader = spark.read.format(row.file_format).schema(schema).option("header", "true")
    return reader.load(f"{path}/{row.folder}/{sheet}")
