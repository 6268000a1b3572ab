"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The tables written so far in each ``passing`` block that is open, the innermost last.
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    ``spark.checkpoint.dir`` names it on a cluster. Where it is unset, a local
    master gets a temporary folder; any other master is an error, as its
    executors would not see such a folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="cedeflow-"))
    return context.getCheckpointDir()


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables written within go when the block ends, but for those that are to outlast it.

    Nothing that still reads one of them may be used after that.
    """
    paths: list[str] = []
    token = _OPEN.set((*_OPEN.get(), paths))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, outlasts: bool = False) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read again.

    Later reads prune its columns, know its size, and survive lost executors.
    The files stay as long as the innermost ``passing`` block does, or the one
    around it if the table ``outlasts`` that, or else the session's checkpoint
    folder. The shuffle files of the write, which nothing reads again, go at its end.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    blocks = _OPEN.get()[:-1] if outlasts else _OPEN.get()
    if blocks:
        blocks[-1].append(path)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
