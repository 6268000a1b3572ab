from __future__ import annotations

from cedeflow.llm.pfair_mix import in_mixed_order, mixed


def _brute(shares: dict, blocks: dict) -> list:
    """Earliest deadline first, slot by slot, with the deviation checked in each."""
    left, order = dict(blocks), []
    while any(left.values()):
        names = sorted(left)
        have = {s: min(shares[s], left[s]) for s in names}
        size, done = sum(have.values()), dict.fromkeys(names, 0)
        for t in range(size):
            open_ = [
                (-(-(done[s] + 1) * size // have[s]), s)
                for s in names
                if done[s] < have[s] and done[s] * size // have[s] <= t
            ]
            taken = min(open_)[1]
            done[taken] += 1
            order.append(taken)
            assert all(abs(done[s] - (t + 1) * have[s] / size) < 1 for s in names)
        for s in names:
            left[s] -= have[s]
    return order


def test_slots_equal_a_simulation(spark, frame):
    sizes, shares = {"a": 300, "b": 90, "c": 41, "d": 1}, {"a": 5, "b": 3, "c": 2, "d": 1}
    rows = [(i, s) for s, n in sizes.items() for i in range(ord(s) * 1000, ord(s) * 1000 + n)]
    docs = frame("doc_id long, source string", *rows)
    weights = frame("key string, share long", *[(f"={s}", k) for s, k in shares.items()])
    got = mixed(docs, weights, block_docs=4, range_docs=50).select("row.*", "slot", "position").collect()
    assert sorted((r.doc_id, r.source) for r in got) == sorted(rows)
    assert len({r.position for r in got}) == len(rows)
    by_slot = {r.slot: r.source for r in got}
    assert all(by_slot[r.slot] == r.source for r in got)
    blocks = {s: -(-n // 4) for s, n in sizes.items()}
    assert [by_slot[i] for i in range(len(by_slot))] == _brute(shares, blocks)


def test_nulls_repeats_clashes_and_no_rows(frame):
    schema = "doc_id long, text string, source string, slot int, position string"
    rows = [(1, "a", None, 7, "x"), (1, "a", None, 7, "x"), (None, None, "s", None, None), (2, "", "", 1, "")]
    got = in_mixed_order(frame(schema, *rows))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
    assert in_mixed_order(frame(schema)).collect() == []
