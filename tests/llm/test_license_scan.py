from __future__ import annotations

import re

import pytest

from cedeflow.llm.license_scan import BASE_NOTICES, evaluate, scan
from cedeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    places = [(i, label) for phrase, label in BASE_NOTICES for i in range(len(words))
              if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def test_query_equals_brute_force(spark, docs_rows):
    texts = {r["doc_id"]: r["text"] for r in docs_rows}
    for r in QUERIES["op4_license_scan"](spark, SF).collect():
        assert tuple(r)[1:6] == _brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


@pytest.mark.parametrize("text", [None, "", "cc by cc-BY all rights reserved", "CC BY-NC 4.0 " * 3000,
                                  "GNU General\nPublic; License é", "\x00cc\x00by\x7f"])
def test_odd_texts(text):
    assert tuple(scan(text).values())[:5] == _brute(text)


@pytest.mark.parametrize("expression, value", [
    ("mit", (0.1, {"mit"})),
    ("mit or gpl-3.0-only and apache-2.0", (0.1, {"mit", "gpl-3.0-only", "apache-2.0"})),
    ("(mit or gpl-3.0-only) and apache-2.0", (0.2, {"mit", "gpl-3.0-only", "apache-2.0"})),
    ("gpl-2.0-only with classpath-exception-2.0", (0.7 * 0.75, {"gpl-2.0-only"})),
    ("mit and strange-1.0", (1.0, {"mit"})),
    ("mit or", (0.1, {"mit"})),
    ("(mit", None),
    ("and mit", None),
    ("", None),
])
def test_expressions(expression, value):
    got = evaluate(expression)
    assert got is None if value is None else (got[0] == pytest.approx(value[0]) and set(got[1]) == value[1])


def test_tagged_expression():
    found = scan("// SPDX-License-Identifier: MIT OR Apache-2.0\nrest and gpl")
    assert found["labels"] == "apache-2.0,mit" and found["score"] == pytest.approx(0.1)
