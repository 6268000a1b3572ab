"""Exact dedup against a persistent index of text digests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cedeflow.llm.storage import written

BUCKETS = 64


def text_digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class DigestIndex:
    """A table ``digest, keep_id``, bucketed and sorted by digest.

    It holds one row for each text seen so far. ``add`` brings a batch: its
    digests are grouped before the shuffle, joined against the index by a
    sort-merge anti-join that moves only the batch, and appended. A text that
    the index has keeps its first ``keep_id``.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int = BUCKETS) -> None:
        self.spark, self.table, self.buckets = spark, table, buckets

    def _append(self, rows: DataFrame) -> None:
        (
            rows.repartition(self.buckets, "digest")
            .write.mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .format("parquet")
            .saveAsTable(self.table)
        )

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows ``digest, keep_id`` of a batch whose digest the index lacks."""
        known = self.spark.table(self.table).select("digest")
        return batch.hint("merge").join(known, "digest", "left_anti")

    def add(self, digests: DataFrame) -> None:
        """Append the new texts of a batch ``doc_id, digest``; of equal texts
        the largest ``doc_id`` is kept, null only if there is no other."""
        batch = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        if self.spark.catalog.tableExists(self.table):
            # written first: a table can't be appended to while it is read
            batch = written(self.unseen(batch))
        self._append(batch)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)


def digests_of(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_digest(F.col("text")).alias("digest"))


def exact_duplicates(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Texts are equal when identical; null counts as empty. The documents come to
    a new index in two batches, the upper half of the ids first, so that of
    equal texts the largest ``doc_id`` stays. Rows that repeat the id that stays
    are all marked kept. A null ``doc_id`` comes last: its row is kept only if
    no other row has the text. An empty table gives an empty one. Other columns
    are not read. The index is dropped once the result is written.
    """
    spark = docs.sparkSession
    digests = written(digests_of(docs))
    ends = digests.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    upper = F.col("doc_id") > ((ends.low or 0) + (ends.high or 0)) // 2
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", buckets)
    try:
        index.add(digests.filter(upper))
        index.add(digests.filter(~F.coalesce(upper, F.lit(False))))
        sizes = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
        kept = index.rows().join(sizes, "digest")
        return written(
            digests.join(kept, "digest").select(
                "doc_id",
                "keep_id",
                "group_size",
                F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                F.lower(F.hex("digest")).alias("text_sha256"),
            )
        )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {index.table}")
