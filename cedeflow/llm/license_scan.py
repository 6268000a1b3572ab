"""Licence notices and identifiers in texts, and the value of their expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: Phrase in words, and label, of the notices that are always reported.
BASE_NOTICES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: More notices, and the licence that each stands for.
NOTICES = (
    ("mit license", "mit"),
    ("apache license version 2 0", "apache-2.0"),
    ("apache license", "apache"),
    ("bsd license", "bsd"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("permission is hereby granted free of charge", "mit"),
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("lesser general public license", "lgpl"),
    ("affero general public license", "agpl"),
    ("free documentation license", "gfdl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("cc by 4 0", "cc-by-4.0"),
    ("cc by sa", "cc-by-sa"),
    ("cc by sa 4 0", "cc-by-sa-4.0"),
    ("cc by nc", "cc-by-nc"),
    ("cc by nc 4 0", "cc-by-nc-4.0"),
    ("cc by nd", "cc-by-nd"),
    ("cc by nc sa", "cc-by-nc-sa"),
    ("cc by nc nd", "cc-by-nc-nd"),
    ("cc0", "cc0-1.0"),
    ("creative commons attribution", "cc-by"),
    ("public domain", "public-domain"),
    ("no part of this publication may be reproduced", "reserved"),
)

#: Tags before a licence expression.
TAGS = ("spdx-license-identifier:", "license-expression:")

#: How much a licence family restricts use, from 0 to 1. The longest prefix of
#: a licence's name decides.
RESTRICTION = {
    "0bsd": 0.05,
    "agpl": 0.9,
    "apache": 0.2,
    "artistic": 0.3,
    "bsd": 0.15,
    "cc-by": 0.3,
    "cc-by-nc": 0.8,
    "cc-by-nd": 0.8,
    "cc-by-sa": 0.5,
    "cc0": 0.05,
    "epl": 0.5,
    "gfdl": 0.6,
    "gpl": 0.7,
    "isc": 0.1,
    "lgpl": 0.6,
    "mit": 0.1,
    "mpl": 0.5,
    "public-domain": 0.05,
    "reserved": 1.0,
    "unlicense": 0.05,
    "zlib": 0.1,
}
#: What an exception leaves of a licence's restriction.
EXCEPTION = 0.75

PRECEDENCE = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")
#: Letters and digits, A-Z lower-cased; every other ASCII byte is a space.
FOLDED = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)

Value = tuple[float, frozenset[str]]


def restriction(licence: str) -> float | None:
    """Of a licence's name, None if its family is unknown."""
    fitting = [
        f for f in RESTRICTION if licence == f or licence.startswith((f"{f}-", f"{f}+"))
    ]
    return RESTRICTION[max(fitting, key=len)] if fitting else None


def _applied(operator: str, left: Value, right: Value) -> Value:
    if operator == "with":
        return left[0] * EXCEPTION, left[1]
    choose = min if operator == "or" else max
    return choose(left[0], right[0]), left[1] | right[1]


def evaluate(expression: str) -> Value | None:
    """Restriction and known licences of a lower-case expression.

    ``or`` leaves the choice of the milder licence, ``and`` binds to the
    stricter, ``with`` takes an exception from the licence before it; ``with``
    binds closest, then ``and``. The longest well-formed beginning counts; a
    name of an unknown family restricts fully and gives no label. None if there
    is no well-formed beginning.
    """
    values: list[Value] = []
    operators: list[str] = []
    best: Value | None = None

    def reduce_while(least: int) -> None:
        while operators and operators[-1] != "(" and PRECEDENCE[operators[-1]] >= least:
            right, left = values.pop(), values.pop()
            values.append(_applied(operators.pop(), left, right))

    operand_next = True
    for token in TOKEN.findall(expression):
        if token == "(" and operand_next:
            operators.append(token)
        elif token == ")" and not operand_next and "(" in operators:
            reduce_while(0)
            operators.pop()
        elif token in PRECEDENCE and not operand_next:
            reduce_while(PRECEDENCE[token])
            operators.append(token)
            operand_next = True
        elif token not in PRECEDENCE and token not in "()" and operand_next:
            known = restriction(token)
            excepted = bool(operators) and operators[-1] == "with"
            named = frozenset() if known is None or excepted else frozenset([token])
            values.append((1.0 if known is None else known, named))
            operand_next = False
        else:
            break
        if not operand_next and "(" not in operators:
            best = _value_so_far(values, operators)
    return best


def _value_so_far(values: list[Value], operators: list[str]) -> Value:
    """The value if the expression ended here."""
    stack, value = values[:-1], values[-1]
    for operator in reversed(operators):
        value = _applied(operator, stack.pop(), value)
    return value


@lru_cache(maxsize=4)
def _automaton(notices: tuple[tuple[str, str, bool], ...]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for phrase, label, base in notices:
        key = f" {phrase} "
        found = automaton.get(key, ())
        automaton.add_word(key, (*found, (len(key), label, base)))
    automaton.make_automaton()
    return automaton


@lru_cache(maxsize=4)
def _tag_automaton(tags: tuple[str, ...]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for tag in tags:
        automaton.add_word(tag, tag)
    automaton.make_automaton()
    return automaton


def scan(
    text: str | None,
    base: tuple[tuple[str, str], ...] = BASE_NOTICES,
    more: tuple[tuple[str, str], ...] = NOTICES,
    tags: tuple[str, ...] = TAGS,
) -> dict[str, object]:
    """What one text says: see ``license_rows``."""
    raw = (text or "").encode()
    words = raw.translate(FOLDED).split()
    spaced = f" {b' '.join(words).decode()} "
    marks = tuple((" ".join(t.encode().translate(FOLDED).decode().split()), "", False) for t in tags)
    notices = (*((p, n, True) for p, n in base), *((p, n, False) for p, n in more), *marks)
    first = last = None
    n_base, base_labels, labels, score, tagged = 0, set(), set(), 0.0, False
    for end, found in _automaton(notices).iter(spaced):
        for length, label, of_base in found:
            if of_base:
                start = end + 1 - length
                n_base += 1
                first = start if first is None else min(first, start)
                last = start if last is None else max(last, start)
                base_labels.add(label)
            if label:
                labels.add(label)
                score = max(score, restriction(label) or 0.0)
            else:
                tagged = True
    if tagged:
        lower = raw.lower().decode()
        for end, _ in _tag_automaton(tags).iter(lower):
            value = evaluate(lower[end + 1 :].split("\n", 1)[0])
            if value:
                score = max(score, value[0])
                labels |= value[1]

    def word_at(start: int | None) -> int | None:
        return None if start is None else spaced.count(" ", 0, start)

    return {
        "n_words": len(words),
        "n_base": n_base,
        "first_word": word_at(first),
        "last_word": word_at(last),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(labels)),
        "score": score,
    }


FIELDS = {
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.string(),
    "labels": pa.string(),
    "score": pa.float64(),
}


def license_rows(
    docs: DataFrame,
    base: tuple[tuple[str, str], ...] = BASE_NOTICES,
    more: tuple[tuple[str, str], ...] = NOTICES,
    tags: tuple[str, ...] = TAGS,
) -> DataFrame:
    """Licence finds of every row: ``doc_id``, word and place counts, labels, score.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
    One automaton finds the words of all notices and tags in a pass over the
    text. ``n_base`` counts the places of the base phrases, ``first_word`` and
    ``last_word`` are their least and largest starts. ``labels`` holds the base
    labels, those of other notices, and the licences of expressions after a tag.
    ``score`` is the restriction of the strictest notice or expression, 0 if
    none is found. A null or empty text has no words, null places and empty
    labels. Rows are judged alone, so repeated ones get equal results; other
    columns are not read.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t.as_py(), base, more, tags) for t in batch.column(1)]
            columns = [pa.array([f[name] for f in found], kind) for name, kind in FIELDS.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *FIELDS])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        of,
        f"doc_id {ids}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )
