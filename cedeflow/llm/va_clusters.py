"""Centroid clustering of integer vectors through a vector-approximation file."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cedeflow.llm.storage import written

#: Bits of a cell number; a dimension has two to this power of cells.
BITS = 6
#: A component times this, rounded down, is its integer.
SCALE = 256
#: Integers stay below this, so that squared distances fit 64 bits.
LIMIT = 1 << 27
#: Vectors of a bucket, of which a task holds a few batches at a time.
BUCKET_ROWS = 250_000
#: Vectors whose intervals are summed at once.
SLICE = 4096
SUMS = "cluster int, sums array<long>"


def usable(vector: Column, dim: int) -> Column:
    """Whether a vector has ``dim`` components, all finite and within the limit."""
    within = F.forall(vector, lambda x: F.coalesce(F.abs(x) < LIMIT // SCALE, F.lit(False)))
    return F.coalesce((F.size(vector) == dim) & within, F.lit(False))


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def _packed(cells: np.ndarray, bits: int) -> np.ndarray:
    """Cell numbers, a row a vector, as the bytes of their ``bits`` low bits."""
    places = np.unpackbits(cells[:, :, None], axis=2, bitorder="little")[:, :, :bits]
    return np.packbits(places.reshape(len(cells), -1), axis=1)


def _unpacked(packed: np.ndarray, dim: int, bits: int) -> np.ndarray:
    places = np.unpackbits(packed, axis=1)[:, : dim * bits].reshape(len(packed), dim, bits)
    return np.packbits(places, axis=2, bitorder="little")[:, :, 0]


def _bytes_matrix(column: pa.Array, dtype: type = np.uint8) -> np.ndarray:
    """Binary values of one length as the rows of a matrix."""
    if len(column) == 0:
        return np.zeros((0, 0), dtype)
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype).reshape(len(column), -1)


def _binaries(matrix: np.ndarray) -> pa.Array:
    width = matrix.shape[1] * matrix.itemsize
    flat = np.ascontiguousarray(matrix).tobytes()
    return pa.array([flat[at : at + width] for at in range(0, len(flat), width)], pa.binary())


class Cells:
    """Cells of about equal filling in every dimension.

    ``inner`` holds the least integer of every cell but the first; the outer
    cells end at the least and greatest integer of all vectors, so that a cell's
    ends are certain bounds.
    """

    def __init__(self, inner: np.ndarray, least: np.ndarray, most: np.ndarray, bits: int) -> None:
        self.inner, self.bits, self.dim = inner, bits, len(inner)
        self.low = np.column_stack([least, inner])
        self.high = np.column_stack([inner - 1, most])

    def of(self, points: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(e, points[:, d], "right") for d, e in enumerate(self.inner)]
        return np.column_stack(columns).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest ``c * c - 2 * x * c`` by dimension, cell and centroid.

        That is what a dimension adds to the squared distance of a vector ``x``
        in the cell, without ``x * x``, which is the same for all centroids.
        """
        c = centroids.T[:, None, :]
        at_low = c * c - 2 * self.low[:, :, None] * c
        at_high = c * c - 2 * self.high[:, :, None] * c
        return np.minimum(at_low, at_high), np.maximum(at_low, at_high)


def fitted_cells(points: DataFrame, bits: int) -> Cells:
    """Cells by the approximate quantiles and the exact ends of all vectors."""
    count = 1 << bits
    fractions = [i / count for i in range(1, count)]
    rows = (
        points.select(F.posexplode("point").alias("d", "x"))
        .groupBy("d")
        .agg(
            F.percentile_approx("x", fractions, 1000).alias("inner"),
            F.min("x").alias("least"),
            F.max("x").alias("most"),
        )
        .orderBy("d")
        .collect()
    )
    inner, least, most = (np.array([row[name] for row in rows]) for name in ("inner", "least", "most"))
    return Cells(inner, least, most, bits)


def first_centroids(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of least SHA-256 of ``seed:vec_id``, in its order."""
    known = F.coalesce(F.col("vec_id").cast("string"), F.lit(""))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), known), 256)
    rows = points.select(drawn.alias("drawn"), "point").orderBy("drawn", "point").limit(k).collect()
    return np.array([row.point for row in rows], np.int64)


class VectorFile:
    """A table ``row, vec_id, cells, point`` in buckets by ``row``.

    Scans that need the cells alone read that column. Full vectors stay in their
    buckets; row numbers and candidates move to them. Assignments are tables
    ``row, old, cluster`` in these buckets.
    """

    def __init__(self, spark: SparkSession, dim: int, cells: Cells, buckets: int) -> None:
        self.spark, self.dim, self.cells, self.buckets = spark, dim, cells, buckets
        self.name = f"vector_file_{uuid.uuid4().hex}"
        self.tables: list[str] = []

    def save(self, rows: DataFrame, name: str) -> DataFrame:
        full = f"{self.name}_{name}"
        self.tables.append(full)
        rows.write.format("parquet").bucketBy(self.buckets, "row").sortBy("row").saveAsTable(full)
        return self.spark.table(full)

    def drop(self, keep: int = 0) -> None:
        """Drops the assignments but for the last ``keep``, or with none, all."""
        first = 1 if keep else 0
        for name in self.tables[first : len(self.tables) - keep]:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.tables.remove(name)

    def fill(self, points: DataFrame) -> DataFrame:
        cells, dim = self.cells, self.dim
        ids = points.schema["vec_id"].dataType.simpleString()

        def approximated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column(2).flatten().to_numpy().reshape(-1, dim)
                columns = [_binaries(_packed(cells.of(values), cells.bits)), _binaries(values.astype("<i4"))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *columns], ["row", "vec_id", "cells", "point"]
                )

        schema = f"row long, vec_id {ids}, cells binary, point binary"
        rows = points.select("row", "vec_id", "point").mapInArrow(approximated, schema)
        return self.save(rows.repartition(self.buckets, "row"), "cells")


def near_centroids(cells: Cells, centroids: np.ndarray):
    """A function from packed cells to the centroids that may be nearest.

    Table look-ups give an interval for every centroid; those stay whose lower
    end is not above the least upper end, as bits. ``only`` is the number of a
    centroid that stays alone, else null.
    """
    low, high = cells.tables(centroids)
    dim, bits = cells.dim, cells.bits

    @F.arrow_udf("near binary, only int")
    def near(packed: pa.Array) -> pa.Array:
        matrix = _bytes_matrix(packed)
        masks, only = [], []
        for at in range(0, len(matrix), SLICE):
            numbers = _unpacked(matrix[at : at + SLICE], dim, bits)
            least = np.zeros((len(numbers), len(centroids)), np.int64)
            most = np.zeros_like(least)
            for d in range(dim):
                least += low[d][numbers[:, d]]
                most += high[d][numbers[:, d]]
            stay = least <= most.min(axis=1, keepdims=True)
            masks.append(np.packbits(stay, axis=1))
            only.append(np.where(stay.sum(axis=1) == 1, stay.argmax(axis=1), -1))
        mask = np.concatenate(masks) if masks else np.zeros((0, 1), np.uint8)
        alone = np.concatenate(only) if only else np.zeros(0, np.int64)
        numbers = pa.array(alone, pa.int32(), mask=alone < 0)
        return pa.StructArray.from_arrays([_binaries(mask), numbers], ["near", "only"])

    return near


def nearest_centroid(centroids: np.ndarray):
    """A function from candidates and full vectors to the nearest centroid, ties
    to the smaller number; null without a vector."""
    k = len(centroids)

    @F.arrow_udf("int")
    def nearest(near: pa.Array, point: pa.Array) -> pa.Array:
        fetched = np.nonzero(np.asarray(point.is_valid()))[0]
        result = np.full(len(point), -1, np.int64)
        for at in range(0, len(fetched), SLICE):
            part = pa.array(fetched[at : at + SLICE])
            masks = np.unpackbits(_bytes_matrix(near.take(part)), axis=1)[:, :k]
            points = _bytes_matrix(point.take(part), np.dtype("<i4")).astype(np.int64)
            distances = np.full(masks.shape, np.iinfo(np.int64).max)
            for c in range(k):
                held = np.nonzero(masks[:, c])[0]
                off = points[held] - centroids[c]
                distances[held, c] = (off * off).sum(axis=1)
            result[fetched[at : at + SLICE]] = distances.argmin(axis=1)
        return pa.array(result, pa.int32(), mask=result < 0)

    return nearest


def distance_to(centroids: np.ndarray):
    """A function from full vectors and clusters to squared distances."""

    @F.arrow_udf("long")
    def distance(point: pa.Array, cluster: pa.Array) -> pa.Array:
        if len(point) == 0:
            return pa.array([], pa.int64())
        off = _bytes_matrix(point, np.dtype("<i4")).astype(np.int64) - centroids[cluster.to_numpy()]
        return pa.array((off * off).sum(axis=1))

    return distance


def _sums(dim: int):
    """A task's counts, which come first, and sums by cluster, each with its sign."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            points = _bytes_matrix(batch.column(0), np.dtype("<i4")).astype(np.int64)
            for sign, column in ((1, batch.column(1)), (-1, batch.column(2))):
                clusters = column.fill_null(-1).to_numpy()
                for c in map(int, np.unique(clusters[clusters >= 0])):
                    held = points[clusters == c]
                    total = sign * np.append(len(held), held.sum(axis=0))
                    sums[c] = sums.get(c, np.zeros(dim + 1, np.int64)) + total
        totals = pa.array(list(sums.values()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), totals], ["cluster", "sums"])

    return of


def assigned(file: DataFrame, state: DataFrame | None, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """``row, old, cluster`` of all vectors.

    Cells decide where one centroid stays; full vectors are joined to the other
    rows only.
    """
    scanned = file.select("row", near_centroids(cells, centroids)("cells").alias("x"))
    rows = scanned.select("row", "x.near", "x.only")
    fetched = file.select(F.col("row").alias("full_row"), "point")
    met = rows.join(fetched, (F.col("row") == F.col("full_row")) & F.col("only").isNull(), "left")
    exact = nearest_centroid(centroids)("near", "point")
    done = met.select("row", F.coalesce("only", exact).alias("cluster"))
    if state is None:
        return done.select("row", F.lit(None).cast("int").alias("old"), "cluster")
    before = state.select("row", F.col("cluster").alias("old"))
    return done.join(before, "row").select("row", "old", "cluster")


def moved_sums(file: DataFrame, state: DataFrame, dim: int) -> DataFrame:
    """``cluster, sums``: what vectors that changed their cluster add to count and sums."""
    moved = state.filter(~F.col("cluster").eqNullSafe(F.col("old")))
    points = moved.join(file.select("row", "point"), "row").select("point", "cluster", "old")
    # a row for each cluster and task, summed place by place
    places = F.array(*(F.sum(F.get("sums", F.lit(at))) for at in range(dim + 1)))
    return points.mapInArrow(_sums(dim), SUMS).groupBy("cluster").agg(places.alias("sums"))


def clustered(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, seed: int = 2, bits: int = BITS
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every kept row.

    Kept are vectors of exactly ``dim`` components, all finite; each component
    becomes ``floor(256 * x)``. A component of ``2 ** 19`` or more counts as not
    finite, as its squares would leave 64 bits. The first centroids are the
    ``k`` vectors of least hash of their ``vec_id``, a null one as an empty
    number, ties by the vector. Every round assigns all vectors to the nearest
    centroid, ties to the smaller number, and moves each centroid that has
    vectors to their exact mean, rounded down; then all are assigned once more.
    Equal rows get equal results; without kept vectors there are no rows. Other
    columns are not read.

    The vectors are written once, as few-bit cells and in full, in buckets by
    row. A round scans the cells, fetches full vectors where the intervals of
    several centroids overlap, and adds those that changed their cluster to the
    sums of the new one and takes them from the old. Only centroids, their
    sums and the cells' ends come to the driver. The tables are dropped once
    the result is written.
    """
    spark = vectors.sparkSession
    points = written(
        vectors.filter(usable(F.col("embedding"), dim))
        .select("vec_id", integers(F.col("embedding")).alias("point"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    count = points.count()
    if not count:
        ids = points.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame(
            [], f"vec_id {ids}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
        )
    centroids = first_centroids(points, k, seed)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    file = VectorFile(spark, dim, fitted_cells(points, bits), max(partitions, -(-count // BUCKET_ROWS)))
    try:
        cells = file.fill(points)
        # sizes in the first column
        state, sums = None, np.zeros((len(centroids), dim + 1), np.int64)
        for number in range(rounds):
            state = file.save(assigned(cells, state, file.cells, centroids), f"round_{number}")
            file.drop(keep=1)
            for row in moved_sums(cells, state, dim).collect():
                sums[row.cluster] += row.sums
            filled = sums[:, 0] > 0
            centroids[filled] = sums[filled, 1:] // sums[filled, :1]
        last = file.save(assigned(cells, state, file.cells, centroids), "last")
        measured = written(
            last.join(cells.select("row", "vec_id", "point"), "row").select(
                "vec_id", "cluster", distance_to(centroids)("point", "cluster").alias("distance")
            )
        )
    finally:
        file.drop()
    by_cluster = measured.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    totals = {row.cluster: row.cluster_inertia for row in by_cluster.collect()}
    facts = spark.createDataFrame(
        [(c, totals[c], sum(totals.values()), [int(x) for x in centroids[c]]) for c in sorted(totals)],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    # a row a centroid
    return measured.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
