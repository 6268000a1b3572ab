from __future__ import annotations

import math
import random

import numpy as np
import pytest

from cedeflow.llm import grid_order_join
from cedeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, seq long, class_id long, n long"


def _table(frame, rows):
    return frame(SCHEMA, *[(i, v, label, 0, 0, 0) for i, v, label in rows])


def _plain(rows, threshold):
    """``(vec_id, n_links, component_id)`` by comparing all pairs."""
    def cosine(x, y):
        dot = math.fsum(a * b for a, b in zip(x, y))
        return dot / math.sqrt(math.fsum(a * a for a in x) * math.fsum(b * b for b in y))

    def fit(row):
        _, v, label = row
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = {i: set() for i in range(len(rows))}
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if fit(a) and fit(b) and a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= threshold:
                links[i].add(j)
                links[j].add(i)
    result = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        known = [rows[j][0] for j in seen if rows[j][0] is not None]
        result.append((row[0], len(links[i]), min(known) if known else None))
    return sorted(result, key=str)


def _got(frame, rows, **settings):
    got = grid_order_join.linked_vectors(_table(frame, rows), **settings).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


def _clusters(rnd, dim, n):
    """Centres with chains of near vectors, one of them hot, and exact copies."""
    rows, centre = [], None
    for i in range(n):
        if centre is None or i % 9 == 0:
            centre = [rnd.gauss(0, 1) for _ in range(dim)]
        step = rnd.choice((0.0, 0.1, 0.25))
        centre = [x + rnd.gauss(0, step) for x in centre]
        rows.append((i, [x * 2.0 ** rnd.randrange(3) for x in centre], rnd.choice((1, 1, 2))))
    hot = [rnd.gauss(0, 1) for _ in range(dim)]
    return rows + [(n + i, [x + rnd.gauss(0, 0.02) for x in hot] if i % 2 else hot, 1) for i in range(60)]


@pytest.mark.parametrize("dim,tile,leaf", [(3, 16, 4), (12, 16, 4), (12, 10_000, 512)])
def test_equals_all_pairs(frame, dim, tile, leaf):
    rows = _clusters(random.Random(dim), dim, 180)
    assert _got(frame, rows, tile_rows=tile, leaf_rows=leaf) == _plain(rows, 0.93)


def test_distant_intervals_are_skipped():
    rnd = np.random.default_rng(1)
    far = np.concatenate([rnd.normal((1, 0, 0), 0.01, (256, 3)), rnd.normal((0, 1, 0), 0.01, (256, 3))])
    vectors = far / np.linalg.norm(far, axis=1)[:, None]
    met = []

    class Links(grid_order_join._Links):
        def _compare(self, a, b):
            met.append((a, b))
            super()._compare(a, b)

    links = Links(vectors, vectors, np.ones(512, np.int64), 0.93)
    links.join((0, 512), (0, 512), 64)
    assert all((a[0] < 256) == (b[0] < 256) for a, b in met)
    assert (links.links == 255).all() and set(links.root) == {0, 256}


def test_threshold_itself_links(frame):
    rows = [(1, [1.0, 0.0], 1), (2, [0.6, 0.8], 1), (3, [3.0, 4.0], 1)]
    assert _got(frame, rows, threshold=0.6) == [(1, 2, 1), (2, 2, 1), (3, 2, 1)]


def test_odd_rows(frame):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], None), (2, [1.0, 0.0], None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0], 1),
        (6, [1.0, None], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, 0.0], 1),
        (9, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (None, [2.0, 0.0], 1), (None, [0.0, 1.0], 3),
        (12, [1e150, 0.0], 1), (13, [-0.0, 1.0], 4), (14, [0.0, 1.0], 4),
    ]
    assert _got(frame, rows) == _plain(rows, 0.93)
    assert _got(frame, []) == []


def test_query(spark):
    got = QUERIES["op13_embedding_near_dedup"](spark, SF)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert got.count() == spark.read.parquet(f"{SF}/embeddings.parquet").count()
