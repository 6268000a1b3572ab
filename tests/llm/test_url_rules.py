from __future__ import annotations

from itertools import combinations

from cedeflow.llm.url_rules import MAX_TOKENS, mined_rules, url_tokens, url_verdicts
from pyspark.sql import functions as F


def test_fixed_rules(frame):
    urls = [
        "https://A.Example.ORG/es/1",
        "http://example.org/en/12?x#y",
        "http://example.org/en/2",
        "http://notexample.org",
        "x://b.com/fr/2",
        "x://b.com/de/2",
        "x://b.net/q?://c.org/",
        "no scheme",
        None,
    ]
    pages = frame("page_id long, url string, host int", *[(i, u, 0) for i, u in enumerate(urls)])
    labels = frame("doc_id long, quality int, toxic int")
    got = [tuple(r)[1:5] for r in url_verdicts(pages, labels).orderBy("page_id").collect()]
    assert got == [
        ("a.example.org", "/es/1", "example.org/es/", "block"),
        ("example.org", "/en/12", "example.org/en/1", "block"),
        ("example.org", "/en/2", "org/", "allow"),
        ("notexample.org", "", None, "allow"),
        ("b.com", "/fr/2", "com/fr/", "allow"),
        ("b.com", "/de/2", "com/de/", "block"),
        ("b.net", "/q", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
    ]


def test_mined_rules_equal_counting_all_sets(frame):
    rows = [(f"http://{h}.site.net/{d}/{i}", h == "bad" or (d == "xx" and i % 3 > 0))
            for h in ("bad", "good", "fine") for d in ("xx", "yy") for i in range(30)]
    labelled = frame("url string, blocked boolean", *rows).select(url_tokens(F.col("url")).alias("tokens"), "blocked")
    sets: dict = {}
    for row in labelled.collect():
        for size in range(1, MAX_TOKENS + 1):
            for chosen in combinations(sorted(row.tokens), size):
                n, bad = sets.get(chosen, (0, 0))
                sets[chosen] = n + 1, bad + row.blocked
    good = {c: bad / n for c, (n, bad) in sets.items() if bad >= 20 and bad / n >= 0.5}
    least = {c: v for c, v in good.items()
             if not any(set(d) < set(c) for d in good)}
    got = {tuple(r.tokens): r.confidence for r in mined_rules(labelled).collect()}
    assert got == least and got


def test_mined_rule_blocks(frame):
    pages = frame("page_id long, url string",
                  *[(i, f"http://bad.site.net/xx/{i}") for i in range(40)],
                  *[(100 + i, f"http://good.site.net/yy/{100 + i}") for i in range(40)])
    labels = frame("doc_id long, quality int, toxic int",
                   *[(i, 0, None) for i in range(30)], *[(100 + i, 1, 0) for i in range(40)])
    got = {r.page_id: (r.verdict, r.rule) for r in url_verdicts(pages, labels).collect()}
    assert all(got[i] == ("block" if i < 100 else "allow", None) for i in got) and len(got) == 80


def test_a_rule_of_four_tokens_is_mined(frame):
    """Confidence is reached by dir, ending, key and scheme together; any three are mostly clean."""
    rows, i = [], 0
    for n in range(16):
        bad = n == 15
        for k in range(40):
            i += 1
            scheme, folder = ("http", "ftp")[not n & 1], ("xx", "yy")[not n & 2]
            ending, key = ("php", "html")[not n & 4], ("id", "no")[not n & 8]
            rows.append((i, f"{scheme}://h{i}.s{i}.d{i}/{folder}/{i}.{ending}?{key}=1", bad and k < 30))
    labelled = frame("doc_id long, url string, blocked boolean", *rows).select(
        url_tokens(F.col("url")).alias("tokens"), "blocked")
    sets: dict = {}
    for row in labelled.collect():
        for size in range(1, len(row.tokens) + 1):
            for chosen in combinations(sorted(row.tokens), size):
                n, bad = sets.get(chosen, (0, 0))
                sets[chosen] = n + 1, bad + row.blocked
    good = {c: bad / n for c, (n, bad) in sets.items() if bad >= 20 and bad / n >= 0.5}
    least = {c: v for c, v in good.items() if not any(set(d) < set(c) for d in good)}
    got = {tuple(r.tokens): r.confidence for r in mined_rules(labelled).collect()}
    assert got == least and [len(c) for c in got] == [4]
    pages = frame("page_id long, url string", *[(i, u) for i, u, _ in rows])
    labels = frame("doc_id long, quality int, toxic int", *[(i, int(not b), 0) for i, _, b in rows])
    blocked = {r.page_id for r in url_verdicts(pages, labels).filter("verdict = 'block'").collect()}
    assert blocked == set(range(601, 641))


def test_many_tokens_of_the_same_urls(frame):
    """Sets of tokens that always go together are not mined one by one."""
    query = "&".join(f"k{i}={i}" for i in range(14))
    rows = [(f"http://{h}.site{h}.net/{d}/{i}?{query}", h == "b" and d == "x")
            for h in ("a", "b", "c") for d in ("x", "y", "z") for i in range(40)]
    labelled = frame("url string, blocked boolean", *rows).select(url_tokens(F.col("url")).alias("tokens"), "blocked")
    got = {tuple(r.tokens): r.confidence for r in mined_rules(labelled).collect()}
    assert got == {("dir:x", t): 1.0 for t in ("first:b", "host:b.siteb.net", "site:siteb.net")}
