"""Near-duplicate documents by SimHash and covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cedeflow.llm.components import connected_components
from cedeflow.llm.storage import written

BITS = 64
#: Buckets of up to so many fingerprints are compared pair by pair; larger ones
#: by the fingerprints next to each, which finds the same links.
PAIRED_BUCKET = 32
SLICE = 1 << 16


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of a text as a signed 64-bit integer; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = [end - 1 for end in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(end + 1 for end in ends[: len(words) - size])]
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(joined[i:j], seed) for i, j in zip(starts, ends[size - 1 :])),
        np.uint64,
        len(starts),
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SLICE):
        part = hashes[at : at + SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, fp`` of every row, from its whole text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array((simhash(t.as_py(), shingle, seed) for t in batch.column(1)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(of, f"doc_id {ids}, fp long")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """Bit masks of which one hides any ``radius`` differing bits, signed.

    Bit ``i`` gets a non-zero vector of ``radius + 1`` bits. Mask ``v`` shows
    the bits whose vector has an odd product with ``v``. ``radius`` vectors
    leave a non-zero ``v`` that is orthogonal to all, so each pair within the
    radius agrees under some mask.
    """
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(bits)]
    masks = []
    for v in range(1, 2 ** (radius + 1)):
        mask = sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
        masks.append(mask - (1 << bits) if mask >> (bits - 1) else mask)
    return masks


def _near(radius: int) -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius


def links(fps: DataFrame, radius: int = 2, paired_bucket: int = PAIRED_BUCKET) -> DataFrame:
    """Edges ``a, b`` that connect distinct fingerprints ``fp`` as all links do.

    Every table of the covering family keys a fingerprint by its masked bits.
    Pairs in small buckets are compared, so a fingerprint meets at most
    ``paired_bucket`` others a table. Two members of a larger bucket are linked
    if and only if flipping up to ``radius / 2`` bits of each can give the same
    value; those who share one are hung on the least of them. That emits a
    fixed number of rows for each fingerprint, however large its bucket.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    tables = F.array(
        *(
            F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(covering_masks(radius))
        )
    )
    keyed = fps.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(keyed.join(sizes, ["t", "key"]))
    small = shared.filter(F.col("n") <= paired_bucket)
    pairs = (
        small.select("t", "key", F.col("fp").alias("a"))
        .join(small.select("t", "key", F.col("fp").alias("b")), ["t", "key"])
        .filter((F.col("a") < F.col("b")) & _near(radius))
        .select("a", "b")
    )
    balls = [0]
    for _ in range(radius // 2):
        balls = sorted({ball ^ (1 << i) for ball in balls for i in range(BITS)} | set(balls))
    flips = F.array(*(F.lit(x - (1 << BITS) if x >> (BITS - 1) else x) for x in balls))
    around = (
        shared.filter(F.col("n") > paired_bucket)
        .select("fp")
        .distinct()
        .select("fp", F.explode(flips).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
    )
    least = around.groupBy("at").agg(F.min("fp").alias("b"), F.max("fp").alias("most"))
    stars = (
        around.join(least.filter("b < most"), "at")
        .filter(F.col("fp") != F.col("b"))
        .select(F.col("fp").alias("a"), "b")
    )
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``.

    A text is lower-cased in A-Z and cut at ASCII white space. Its fingerprint
    has a bit set if more than half the XXH64 hashes of its word shingles,
    repeats included, have it; a text of fewer words is one shingle, a null,
    empty or blank one has fingerprint zero and is linked like any other.
    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is
    the smallest ``doc_id`` reachable over links. A null ``doc_id`` gets a row,
    and names a component only if no other id does, as null. Equal rows get
    equal results; other columns are not read.
    """
    of_docs = written(fingerprints(docs, shingle, seed))
    classes = written(of_docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    of_fps = connected_components(links(classes.select("fp"), radius), "a", "b")
    rooted = classes.join(of_fps, classes.fp == of_fps.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    return of_docs.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the smallest of its component.

    Rows that repeat a kept ``doc_id`` stay with it, and so do rows without an
    id, as nothing tells which of them another row repeats.
    """
    groups = near_duplicates(docs, radius)
    dropped = groups.filter("doc_id != component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")
