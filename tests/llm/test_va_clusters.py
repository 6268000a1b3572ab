from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from cedeflow.llm import va_clusters
from cedeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, row long, cluster int, cells int"


def _table(frame, vectors):
    return frame(SCHEMA, *[(i, v, 1, 0, 0, 0) for i, v in vectors])


def _plain(vectors, k, rounds, seed=2):
    """``(vec_id, cluster, distance)`` by comparing every vector with every centroid."""
    points = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in vectors]
    drawn = sorted(points, key=lambda p: (hashlib.sha256(f"{seed}:{p[0]}".encode()).hexdigest(), p[1]))
    centroids = [list(p) for _, p in drawn[:k]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), at) for at, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(p)[1] for _, p in points]
        for c in range(len(centroids)):
            held = [p for (_, p), at in zip(points, of) if at == c]
            if held:
                centroids[c] = [sum(xs) // len(held) for xs in zip(*held)]
    rows = []
    for i, p in points:
        distance, c = nearest(p)
        rows.append((i, c, distance))
    return sorted(rows), centroids


@pytest.mark.parametrize("bits", [2, 6])
def test_equals_plain_search(frame, bits):
    rnd = random.Random(bits)
    centres = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    vectors = [(i, [x + rnd.gauss(0, 0.3) for x in rnd.choice(centres)]) for i in range(150)]
    vectors += [(200 + i, [0.5] * 6) for i in range(40)] + [(300, [-900.0] * 6), (5, vectors[5][1])]
    expected, centroids = _plain(vectors, 7, 3)
    got = va_clusters.clustered(_table(frame, vectors), k=7, rounds=3, dim=6, bits=bits).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == expected
    assert {r.inertia for r in got} == {sum(d for _, _, d in expected)}
    for r in got:
        assert list(r.centroid) == centroids[r.cluster]
        assert r.cluster_inertia == sum(d for _, c, d in expected if c == r.cluster)


def test_intervals_hold_the_distances():
    rnd = np.random.default_rng(3)
    points = rnd.integers(-300, 300, (400, 5))
    centroids = rnd.integers(-300, 300, (9, 5))
    inner = np.sort(rnd.integers(-300, 300, (5, 7)), axis=1)
    cells = va_clusters.Cells(inner, points.min(axis=0), points.max(axis=0), 3)
    numbers = va_clusters._unpacked(va_clusters._packed(cells.of(points), 3), 5, 3)
    assert (numbers == cells.of(points)).all()
    low, high = cells.tables(centroids)
    least = sum(low[d][numbers[:, d]] for d in range(5))
    most = sum(high[d][numbers[:, d]] for d in range(5))
    exact = ((points[:, None] - centroids[None]) ** 2).sum(axis=2) - (points**2).sum(axis=1)[:, None]
    assert (least <= exact).all() and (exact <= most).all()


def test_odd_rows(frame):
    nan, inf = float("nan"), float("inf")
    kept = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (None, [1.0, 1.0]), (2, [0.5, 0.5])]
    left = [(3, None), (4, []), (5, [1.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1e6, 0.0])]
    got = va_clusters.clustered(_table(frame, kept + left), k=40, rounds=2, dim=2).collect()
    assert sorted((str(r.vec_id), r.distance) for r in got) == [("1", 0), ("2", 0), ("2", 0), ("None", 0)]
    # equal vectors go to the first of equal centroids
    assert len({r.cluster for r in got if r.vec_id}) == 1
    assert va_clusters.clustered(_table(frame, left), dim=2).collect() == []
    assert va_clusters.clustered(frame(SCHEMA), dim=2).collect() == []


def test_tables_are_dropped(spark):
    QUERIES["op11_centroid_clustering"](spark, SF).collect()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("vector_file")]
