"""Near-duplicate vectors by an epsilon grid order join on principal dimensions."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cedeflow.llm.components import connected_components
from cedeflow.llm.storage import written

#: Leading principal dimensions, by which vectors are ordered and blocks are told apart.
LEADING = 8
#: Vectors of a tile; two tiles are what a task holds.
TILE_ROWS = 8192
#: Vectors of the last intervals of the recursion, which are compared by a product.
LEAF_ROWS = 512
#: Children of an interval of tiles.
FAN = 4
#: A vector that more than one in so many rows holds is looked up by broadcast.
SHARES = 1000
#: Lets rounding skip no block and decide no pair.
SLACK = 1e-9

GROUP = ["label", "dim"]


def usable(label: Column, vector: Column) -> Column:
    """Whether a vector can be linked: a label, finite components, not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _scaled(column: pa.Array, dim: int) -> np.ndarray:
    """List values of one length, a row each, over a power of two near the largest."""
    vectors = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    _, exponents = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponents)


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def principal_axes(classes: DataFrame, dim: int, leading: int) -> np.ndarray:
    """The leading axes of all unit vectors of one length, a row each.

    Every task sums its products; Spark sums those, and ``dim * dim`` numbers
    reach the driver. The axes only decide what is skipped early.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        second, first, n = np.zeros((dim, dim)), np.zeros(dim), 0
        for batch in batches:
            vectors = _units(_scaled(batch.column(0), dim))
            second += vectors.T @ vectors
            first += vectors.sum(axis=0)
            n += len(vectors)
        for i, row in enumerate([*second, first, np.full(dim, n)]):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * dim), pa.array(range(dim)), pa.array(row, pa.float64())], ["i", "j", "x"]
            )

    parts = classes.filter(F.col("dim") == dim).select("embedding")
    total = parts.mapInArrow(sums, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    moments = np.zeros((dim + 2, dim))
    for row in total.collect():
        moments[row.i, row.j] = row.x
    n = max(moments[dim + 1, 0], 1.0)
    mean = moments[dim] / n
    _, axes = np.linalg.eigh(moments[:dim] / n - np.outer(mean, mean))
    return axes.T[::-1][:leading]


def leading_coordinates(vectors: np.ndarray, axes: np.ndarray | None, leading: int) -> np.ndarray:
    """Coordinates along the axes, or the first ones where no axes are known."""
    return vectors @ axes.T if axes is not None else vectors[:, :leading]


def _ordered(classes: DataFrame, eps: float, axes: dict[int, np.ndarray], leading: int) -> DataFrame:
    """The classes in grid order, numbered as ``seq`` within label and length.

    A range partitioning by the cells sorts them; a group's rows of a range are
    numbered where they are, and the groups' counts by range, a small table,
    give each range its start.
    """
    names = ["class_id", "label", "dim", "n", "embedding"]

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                vectors = _units(_scaled(part.column(4), int(dim)))
                at = leading_coordinates(vectors, axes.get(int(dim)), leading)
                lists = pa.array(list(at), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*names, "lead"])

    rows = classes.select(*names)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    cells = F.transform("lead", lambda x: F.floor(x / eps))
    order = [*GROUP, "cells", "class_id"]
    sorted_rows = written(
        rows.mapInArrow(lead, f"{schema}, lead array<double>")
        .withColumn("cells", cells)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("cells")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("range", F.shiftright("at", 33))
    )
    before = Window.partitionBy(*GROUP).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sorted_rows.groupBy(*GROUP, "range")
        .agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("held"))
        .withColumn("start", F.coalesce(F.sum("held").over(before), F.lit(0)))
        .drop("held")
    )
    return sorted_rows.join(starts, [*GROUP, "range"]).withColumn(
        "seq", F.col("start") + F.col("at") - F.col("first_at")
    ).drop("at", "range", "start", "first_at")


def _boxes(rows: DataFrame, node: Column, low: Column, high: Column, leading: int) -> DataFrame:
    """``label, dim, node`` with the least and greatest leading coordinates."""
    ends = rows.groupBy(*GROUP, node.alias("node")).agg(
        *(F.min(F.get(low, F.lit(i))).alias(f"l{i}") for i in range(leading)),
        *(F.max(F.get(high, F.lit(i))).alias(f"h{i}") for i in range(leading)),
    )
    return ends.select(
        *GROUP,
        "node",
        F.array(*(f"l{i}" for i in range(leading))).alias("low"),
        F.array(*(f"h{i}" for i in range(leading))).alias("high"),
    )


def _near_boxes(eps: float) -> Column:
    """Whether boxes ``a`` and ``b`` may hold vectors within ``eps`` of each other.

    A short vector lacks the last coordinates; they add nothing.
    """
    gaps = F.zip_with(
        F.zip_with("a.low", "b.high", lambda low, high: low - high),
        F.zip_with("b.low", "a.high", lambda low, high: low - high),
        lambda x, y: F.coalesce(F.greatest(x, y, F.lit(0.0)), F.lit(0.0)),
    )
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= eps * eps * (1 + SLACK) + SLACK


def near_tiles(ordered: DataFrame, eps: float, tile_rows: int, leading: int, fan: int = FAN) -> DataFrame:
    """``label, dim, a, b`` with ``a <= b``: tiles that may hold links.

    Intervals of a group's sequence are joined top down, beginning with the
    whole against itself: the children of a pair that is not provably distant
    meet each other, until the intervals are tiles.
    """
    tile = F.floor(F.col("seq") / tile_rows)
    tiles = written(_boxes(ordered, tile, F.col("lead"), F.col("lead"), leading))
    last = tiles.agg(F.max("node")).first()[0] or 0
    levels = 0
    while fan**levels <= last:
        levels += 1
    pairs = tiles.select(*GROUP, F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).distinct()
    children = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(fan) for j in range(fan)))
    for level in range(levels - 1, -1, -1):
        width = fan**level
        boxes = written(_boxes(tiles, F.floor(F.col("node") / width), F.col("low"), F.col("high"), leading))
        split = (
            pairs.select(*GROUP, "a", "b", F.inline(children))
            .select(*GROUP, (F.col("a") * fan + F.col("i")).alias("a"), (F.col("b") * fan + F.col("j")).alias("b"))
            .filter("a <= b")
        )
        left = boxes.select(*GROUP, F.col("node").alias("a"), F.struct("low", "high").alias("box_a"))
        right = boxes.select(*GROUP, F.col("node").alias("b"), F.struct("low", "high").alias("box_b"))
        met = split.join(left, [*GROUP, "a"]).join(right, [*GROUP, "b"])
        pairs = written(
            met.select(*GROUP, "a", "b", F.struct(F.col("box_a").alias("a"), F.col("box_b").alias("b")).alias("x"))
            .withColumns({"pa": F.col("a"), "pb": F.col("b"), "a": F.col("x.a"), "b": F.col("x.b")})
            .filter(_near_boxes(eps))
            .select(*GROUP, F.col("pa").alias("a"), F.col("pb").alias("b"))
        )
    return pairs


class _Links:
    """Links of the vectors of one or two tiles, as counts and components."""

    def __init__(self, scaled: np.ndarray, lead: np.ndarray, n: np.ndarray, threshold: float) -> None:
        self.scaled, self.vectors = scaled, _units(scaled)
        self.lead, self.n, self.threshold = lead, n, threshold
        self.limit = (2 - 2 * threshold) * (1 + SLACK) + SLACK
        self.links = np.zeros(len(scaled), np.int64)
        self.root = np.arange(len(scaled))
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def _box(self, interval: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        if interval not in self.boxes:
            part = self.lead[slice(*interval)]
            self.boxes[interval] = part.min(axis=0), part.max(axis=0)
        return self.boxes[interval]

    def _distant(self, a: tuple[int, int], b: tuple[int, int]) -> bool:
        (low_a, high_a), (low_b, high_b) = self._box(a), self._box(b)
        gaps = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
        return gaps @ gaps > self.limit

    def join(self, a: tuple[int, int], b: tuple[int, int], leaf: int) -> None:
        """Joins two intervals, the halves of the longer ones first."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if a[0] == a[1] or b[0] == b[1] or (a != b and self._distant(a, b)):
                continue
            sizes = a[1] - a[0], b[1] - b[0]
            if max(sizes) <= leaf:
                self._compare(a, b)
            elif a == b:
                middle = sum(a) // 2
                left, right = (a[0], middle), (middle, a[1])
                stack += [(left, left), (left, right), (right, right)]
            elif sizes[0] >= sizes[1]:
                middle = sum(a) // 2
                stack += [((a[0], middle), b), ((middle, a[1]), b)]
            else:
                middle = sum(b) // 2
                stack += [(a, (b[0], middle)), (a, (middle, b[1]))]

    def _cosine(self, i: int, j: int) -> float:
        x, y = self.scaled[i], self.scaled[j]
        return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))

    def _compare(self, a: tuple[int, int], b: tuple[int, int]) -> None:
        cosines = self.vectors[slice(*a)] @ self.vectors[slice(*b)].T
        for i, j in np.argwhere(np.abs(cosines - self.threshold) < SLACK):
            # a sum without rounding, whatever the order of the product's terms
            cosines[i, j] = self._cosine(a[0] + i, b[0] + j)
        hits = cosines >= self.threshold
        if a == b:
            np.fill_diagonal(hits, False)
        if not hits.any():
            return
        self.links[slice(*a)] += hits @ self.n[slice(*b)]
        if a != b:
            self.links[slice(*b)] += self.n[slice(*a)] @ hits
        i, j = np.nonzero(hits)
        self._unite(i + a[0], j + b[0])

    def _unite(self, i: np.ndarray, j: np.ndarray) -> None:
        """Merges the components of linked vectors; ``root`` names the least."""
        root = self.root
        while True:
            x, y = root[i], root[j]
            apart = x != y
            if not apart.any():
                return
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(root[root], root):
                root[:] = root[root]


def _tile_links(
    table: pa.Table, threshold: float, axes: dict[int, np.ndarray], leading: int, leaf: int
) -> pa.Table:
    """``class_id, links, root`` of the linked classes of a pair of tiles."""
    table = table.sort_by("seq").combine_chunks()
    dim = table.column("dim")[0].as_py()
    scaled = _scaled(table.column("embedding").combine_chunks(), dim)
    lead = leading_coordinates(_units(scaled), axes.get(dim), leading)
    found = _Links(scaled, lead, table.column("n").to_numpy(), threshold)
    a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
    cut = int((table.column("tile").to_numpy() == a).sum())
    found.join((0, cut), (0, cut) if a == b else (cut, len(scaled)), leaf)
    linked = np.nonzero(found.links)[0]
    ids = table.column("class_id").to_numpy()
    return pa.table(
        {"class_id": ids[linked], "links": found.links[linked], "root": ids[found.root[linked]]}
    )


def _class_links(
    classes: DataFrame, threshold: float, tile_rows: int, leaf_rows: int, leading: int
) -> DataFrame:
    """``class_id, links, root`` for every near pair of tiles, written."""
    eps = math.sqrt(2 - 2 * threshold)
    common = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    axes = {common.dim: principal_axes(classes, common.dim, leading)} if common else {}
    ordered = written(_ordered(classes, eps, axes, leading))
    pairs = near_tiles(ordered, eps, tile_rows, leading)
    tile = F.floor(F.col("seq") / tile_rows).alias("tile")
    rows = ordered.select(*GROUP, "class_id", "n", "embedding", "seq", tile)
    sides = pairs.select(
        *GROUP, "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile")
    )

    def links(table: pa.Table) -> pa.Table:
        return _tile_links(table, threshold, axes, leading, leaf_rows)

    return written(
        rows.join(sides, [*GROUP, "tile"])
        .groupBy(*GROUP, "a", "b")
        .applyInArrow(links, "class_id long, links long, root long")
    )


def linked_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    tile_rows: int = TILE_ROWS,
    leaf_rows: int = LEAF_ROWS,
    leading: int = LEADING,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors``.

    Rows ``vec_id, label, embedding`` are linked if label and length are equal
    and the cosine is ``threshold`` or more, in double precision. ``n_links``
    counts the other rows linked directly, ``component_id`` is the smallest
    ``vec_id`` reachable, itself included; the row that has it is kept. A null
    label, a null, empty or zero vector and one with a null or non-finite
    component link with nothing. Rows that repeat a ``vec_id`` are rows of their
    own; a null ``vec_id`` names a component only if no other id does, as null.
    An empty table gives an empty one. Other columns are not read.

    Equal vectors of a label are one class with a count, so copies make no
    pairs. Classes are sorted by grid cells of side epsilon, the distance of two
    unit vectors at the threshold, on the leading principal dimensions. The
    sequence of a label is cut into tiles; intervals of tiles, then of vectors
    within two tiles, are joined top down, and those whose boxes are over
    epsilon apart are skipped. A task holds two tiles and sends on counts and a
    star for each of its components.
    """
    rows = written(vectors.select("vec_id", "label", "embedding"))
    good = usable(F.col("label"), F.col("embedding"))
    same = ["label", "embedding"]
    classes = written(
        rows.filter(good)
        .groupBy(*same)
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .withColumn("dim", F.size("embedding").cast("long"))
        .withColumn("class_id", F.monotonically_increasing_id())
    )
    found = _class_links(classes, threshold, tile_rows, leaf_rows, leading)
    counts = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    stars = connected_components(found.select("class_id", "root"), "class_id", "root")
    members = classes.select("class_id", "first_id").join(stars, F.col("class_id") == F.col("node"))
    named = members.groupBy("component").agg(F.min("first_id").alias("least_id"))
    of_class = members.join(named, "component").select("class_id", "least_id")
    # a vector of its own needs no lookup
    results = written(
        classes.join(counts, "class_id", "left")
        .join(of_class, "class_id", "left")
        .filter((F.col("n") > 1) | F.col("links").isNotNull())
        .select(
            *same,
            "n",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("least_id", "first_id").alias("component_id"),
        )
    )
    total = rows.count()
    is_common = F.col("n") * SHARES > total
    values = [*same, "n_links", "component_id"]
    common = results.filter(is_common).select(*same, F.struct("n_links", "component_id").alias("common"))
    rare = results.filter(~is_common).select(*values)
    looked_up = rows.filter(good).join(F.broadcast(common), same, "left")
    parts = [
        looked_up.filter(F.col("common").isNotNull()).select("vec_id", "common.n_links", "common.component_id"),
        looked_up.filter(F.col("common").isNull()).join(rare, same, "left").select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        rows.filter(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
