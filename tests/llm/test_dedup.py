from __future__ import annotations

import hashlib
import random

import pytest
import xxhash

from cedeflow.llm.components import connected_components
from cedeflow.llm.covering_simhash import (
    covering_masks,
    links,
    near_duplicates,
    one_of_each_group,
    simhash,
)
from cedeflow.llm.digest_index import DigestIndex, digests_of, exact_duplicates
from cedeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _components(nodes, edges):
    group = {n: n for n in nodes}

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        group[y] = x
    return {n: root(n) for n in nodes}


def _fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lower.replace("\t", " ").replace("\n", " ").replace("\r", " ")
             .replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components(spark, frame):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    table = frame("a long, b long", *edges, *edges[:5], (None, 1), (7, 7))
    got = {r.node: r.component for r in connected_components(table, "a", "b").collect()}
    real = [e for e in edges if e[0] != e[1]]
    assert got == _components({n for e in real for n in e}, real)
    assert connected_components(frame("a long, b long"), "a", "b").collect() == []


def test_near_duplicates_equal_brute_force(spark, docs_rows):
    fps = {r["doc_id"]: _fingerprint(r["text"]) for r in docs_rows}
    ids = sorted(fps)
    edges = [(a, b) for k, b in enumerate(ids) for a in ids[:k] if (fps[a] ^ fps[b]).bit_count() <= 2]
    component = _components(ids, edges)
    got = QUERIES["op6_simhash_near_dedup"](spark, SF).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{fps[i]:016x}" for i in ids}
    assert {r.doc_id: r.component_id for r in got} == component and len(got) == len(ids)


@pytest.mark.parametrize("paired", [2, 1000])
def test_links_connect_as_all_pairs_do(frame, paired):
    rnd = random.Random(9)
    fps = {rnd.getrandbits(64) for _ in range(40)}
    for f in list(fps)[:10]:
        for _ in range(12):
            f ^= sum(1 << b for b in rnd.sample(range(64), rnd.choice((1, 2, 3))))
            fps.add(f)
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    table = frame("fp long", *[(f,) for f in signed])
    got = [(r.a, r.b) for r in links(table, 2, paired).collect()]
    all_pairs = [(a, b) for k, b in enumerate(signed) for a in signed[:k]
                 if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in got)
    assert _components(signed, got) == _components(signed, all_pairs)


def test_masks_cover_every_pair_of_bits():
    masks = [m & (2**64 - 1) for m in covering_masks(2)]
    for i in range(64):
        for j in range(i + 1):
            assert any(not m & (1 << i | 1 << j) for m in masks)


def test_near_duplicates_of_odd_rows(frame):
    schema = "doc_id long, text string, fp string"
    rows = [(5, None, "x"), (4, "", "x"), (9, " \t", None), (1, "Only TWO", ""), (2, "only  two", ""),
            (2, "only  two", ""), (None, "alone here today my friend", "")]
    got = {(r.doc_id, r.component_id) for r in near_duplicates(frame(schema, *rows)).collect()}
    assert got == {(5, 4), (4, 4), (9, 4), (1, 1), (2, 1), (None, None)}
    assert simhash("ONLY two") == simhash("only\ntwo") != 0 == simhash(None)
    kept = one_of_each_group(frame(schema, *rows))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert {r.doc_id for r in kept.collect()} == {4, 1, None}
    assert near_duplicates(frame(schema)).collect() == []


def test_exact_duplicates(frame):
    schema = "doc_id long, text string, digest string"
    rows = [(1, "a", ""), (7, "a", ""), (3, "A", ""), (4, None, ""), (5, "", ""), (6, "long " * 50000, ""),
            (7, "a", ""), (None, "a", ""), (None, "only", "")]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_duplicates(frame(schema, *rows)).collect()}
    assert got == {(1, 7, 4, False), (7, 7, 4, True), (None, 7, 4, False), (3, 3, 1, True), (4, 5, 2, False),
                   (5, 5, 2, True), (6, 6, 1, True), (None, None, 1, True)}
    digest = {r.doc_id: r.text_sha256 for r in exact_duplicates(frame(schema, *rows)).collect()}
    assert digest[4] == hashlib.sha256(b"").hexdigest() and digest[3] == hashlib.sha256(b"A").hexdigest()
    assert exact_duplicates(frame(schema)).collect() == []


def test_index_is_read_in_buckets(spark, frame):
    index = DigestIndex(spark, "digests_of_a_test", buckets=4)
    try:
        index.add(digests_of(frame("doc_id long, text string", (1, "a"), (2, "b"))))
        index.add(digests_of(frame("doc_id long, text string", (8, "a"), (9, "c"))))
        assert sorted(r.keep_id for r in index.rows().collect()) == [1, 2, 9]
        batch = digests_of(frame("doc_id long, text string", (10, "d")))
        plan = index.unseen(batch)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange") == 1  # of the batch alone
    finally:
        spark.sql("DROP TABLE IF EXISTS digests_of_a_test")
