from __future__ import annotations

import random

import pytest
import sentencepiece

from cedeflow.llm.ordinal_toxicity import fit, graded, without_rejected
from cedeflow.llm.suffix_pieces import (
    DEFAULT_MODEL,
    Encoder,
    PieceTable,
    decoded,
    encoded,
    round_trips,
    suffix_array,
)

ODD = [None, "", "a", " a", "a ", "  ", "a  b", "\n", "\t\n x", "日本語 text 🙂", "▁x", "x▁▁y", "\x00a\x00",
       "<s> </s> <unk> <0x0A>", "é" * 50, "abc" * 3000, " " * 40, "        def f(x):\n        return x\n"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=DEFAULT_MODEL)


def test_ids_are_those_of_the_library(frame, docs_rows, library):
    texts = ODD + [r["text"] for r in docs_rows]
    table = frame("doc_id long, text string, fp int", *[(i, t, 0) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in encoded(table).collect()}
    for i, text in enumerate(texts):
        assert list(got[i].ids) == library.encode(text or "")
        assert got[i].n_tokens == len(got[i].ids)
    assert encoded(table.limit(0)).collect() == []


def test_texts_come_back(frame, docs_rows):
    texts = ODD + [r["text"] for r in docs_rows]
    table = frame("doc_id long, text string", *enumerate(texts), *enumerate(texts))
    assert all(r.same_text for r in round_trips(table).collect())
    back = decoded(frame("doc_id long, ids array<int>", (1, None), (2, []), (3, [259 + 10]))).collect()
    assert [r.decoded for r in back][:2] == ["", ""]


def test_small_indexes_give_the_same(docs_rows, library, monkeypatch):
    monkeypatch.setattr("cedeflow.llm.suffix_pieces.INDEXED", 50)
    monkeypatch.setattr("cedeflow.llm.suffix_pieces.KEPT_RUNS", 100)
    encoder = Encoder(PieceTable.load(DEFAULT_MODEL))
    texts = [r["text"][:300] for r in docs_rows[:8]]
    for _ in range(2):
        ids, ends = encoder.encode(texts)
        assert [list(ids[a:b]) for a, b in zip([0, *ends], ends)] == library.encode(texts)


def test_suffix_array():
    import numpy as np

    text = np.array([ord(c) for c in "banana\0bandana\0"], np.int32)
    order = suffix_array(text, 16)
    suffixes = [text[i:].tolist() for i in order]
    assert suffixes == sorted(suffixes)


def _toxic_rows(n, seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 8))) for _ in range(500)]
    bad = ["vileword", "nastyword", "foulword"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = rnd.choices(words, k=rnd.randint(20, 120))
        for _ in range(rnd.randint(1, 6) if toxic else 0):
            text.insert(rnd.randrange(len(text)), rnd.choice(bad))
        docs.append((i, " ".join(text), i * 1.0))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_order(frame):
    rows, labels = _toxic_rows(1200, 4)
    docs = frame("doc_id long, text string, severity double", *rows)
    model = fit(docs, frame("doc_id long, toxic int", *labels[:600]))
    assert model.thresholds == sorted(model.thresholds)
    got = {r.doc_id: r for r in graded(docs, model).collect()}
    assert all(got[i].rejected == bool(t) for i, t in labels[600:])
    text = dict((i, t) for i, t, _ in rows)
    count = {i: sum(w in ("vileword", "nastyword", "foulword") for w in t.split()) for i, t in text.items()}
    mild = [got[i].severity for i in got if count[i] == 1]
    harsh = [got[i].severity for i in got if count[i] >= 5]
    assert sum(mild) / len(mild) < sum(harsh) / len(harsh)
    kept = without_rejected(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].rejected}


def test_odd_labels_and_texts(frame):
    docs = frame("doc_id long, text string", (1, None), (1, None), (2, ""), (None, "x " * 100000))
    for labels in ([], [(1, None), (None, 1)], [(1, 1)], [(2, 0), (2, 0)]):
        model = fit(docs, frame("doc_id long, toxic int", *labels))
        got = graded(docs, model).collect()
        assert len(got) == 4 and not any(r.rejected for r in got)
    assert graded(docs.limit(0), model).collect() == []
