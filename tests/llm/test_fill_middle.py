from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from cedeflow.llm import fill_middle
from cedeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def _plain(doc_id, text):
    """``n, form, prefix_chars, middle_chars, output`` by finding unit after unit."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_plain(spark, docs_rows):
    got = {r.doc_id: r for r in QUERIES["op12_fill_in_middle"](spark, SF).collect()}
    assert len(got) == len(docs_rows)
    for row in docs_rows:
        n, form, prefix, middle, output = _plain(row["doc_id"], row["text"])
        r = got[row["doc_id"]]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (_sha(output), _sha(row["text"]))
    assert {r.form for r in got.values()} == {"plain", "spm", "psm"}


def test_odd_texts(frame):
    odd = [
        None, "", " ", "\n\n", "a", " a b", "a \n", "a　b c", "<P", "<<S", "S> x <", "x <P> y", "<M>",
        "\U0001f600 \U0001f601  z\t", "word " * 200_000, "x" * 300_000, "\x1f\x85 b", "a\x00b c",
    ]
    # every text under several ids, so that it takes every form
    rows = [(100 * i + k, t) for i, t in enumerate(odd) for k in range(12)] + [(None, "a b c")] * 2
    table = frame("doc_id long, text string, n int, form string, output string", *[(*r, 1, "", "") for r in rows])
    out = fill_middle.fill_in_middle(table)
    out = out.withColumn("again", fill_middle.restored(F.col("output"), F.col("form")))
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted(((i, *_plain(i, t), t or "") for i, t in rows), key=str)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}
    assert fill_middle.fill_in_middle(table.limit(0)).collect() == []


def test_rates(frame):
    table = frame("doc_id long, text string", *[(i, "one two three") for i in range(400)])
    forms = [r.form for r in fill_middle.fill_in_middle(table, seed=1, rate=100, spm_rate=0).collect()]
    assert set(forms) == {"psm"}
    assert {r.form for r in fill_middle.fill_in_middle(table, rate=0).collect()} == {"plain"}
