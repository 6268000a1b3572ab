from __future__ import annotations

import random
import re

from cedeflow.llm.queries import QUERIES
from cedeflow.llm.robust_quality import quality_verdicts

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


def _brute(text):
    text = text or ""
    words, seen, repeated, covered, places = WORD.findall(text), set(), 0, set(), {}
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    for found in places.values():
        if len(found) > 1:
            covered.update(p + k for p in found for k in range(5))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated,
            len(covered), failed)


def test_query_equals_brute_force(spark, docs_rows):
    texts = {r["doc_id"]: r["text"] for r in docs_rows}
    for r in QUERIES["op7_quality_rules"](spark, SF).collect():
        assert tuple(r)[1:7] == _brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_outliers_go_and_the_rest_stays(docs):
    rnd = random.Random(2)
    vocabulary = ["".join(rnd.choices("etaoinshr", k=rnd.randint(2, 9))) for _ in range(900)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(20, 400)))) for i in range(400)]
    junk = [(1000 + i, " ".join(w + "###" for w in rnd.choices(vocabulary, k=80))) for i in range(40)]
    got = {r.doc_id: r.kept for r in quality_verdicts(docs(*rows, *junk)).collect()}
    assert all(got[i] for i, _ in rows) and not any(got[i] for i, _ in junk)


def test_rows_of_a_rare_language_are_judged_too(frame):
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choices("etaoinshr", k=rnd.randint(2, 9))) for _ in range(900)]

    def text(ending=""):
        return " ".join(w + ending for w in rnd.choices(vocabulary, k=rnd.randint(30, 300)))

    rows = [(i, text(), "en", "s") for i in range(300)] + [(400 + i, text(), "xx", "s") for i in range(70)]
    junk = [(1000 + i, text("###"), "xx", "s") for i in range(10)]
    alone = [(2000, text(), None, None), (2001, text("###"), None, None)]
    table = frame("doc_id long, text string, lang string, source string", *rows, *junk, *alone)
    got = {r.doc_id: r for r in quality_verdicts(table).collect()}
    assert all(got[i].kept for i, *_ in rows) and not any(got[i].kept for i, *_ in junk)
    assert got[2000].kept and not got[2001].kept
    assert all((r.distance2 is None) == r.base_failed for r in got.values())


def test_odd_rows(frame):
    schema = "doc_id long, text string, lang string, source string, d2 string"
    texts = [None, "", " \n\t", "a b c d e f g h i j", " x " * 12, "a b c d e " * 40,
             "w " + "x y z\n" * 30000, "one\nTwo\none\n\n\none #*$"]
    rows = [(i, t, None if i % 2 else "en", None, "") for i, t in enumerate(texts)] * 2
    got = quality_verdicts(frame(schema, *rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:7] == _brute(texts[r.doc_id])
        # those that pass are equal, so at the centre of all rows
        assert r.kept == (not r.base_failed) and r.distance2 == (None if r.base_failed else 0)
    assert quality_verdicts(frame(schema)).collect() == []
