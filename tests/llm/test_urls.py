from __future__ import annotations

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from toneflow.llm import queries, urls

URLS = [(1, "HTTP://WWW.Example.com/en/1?q=//x"), (2, "http://example.com/en/2#a/b"), (3, "http://example.com"), (4, "http://notexample.com/en/"),
        (5, "//example.com/en/"), (6, None), (7, ""), (8, "x://a.NET/es/é?y"), (9, "http://net/fr/"), (10, "http://a.net/frx"),
        (11, "http://a.org/en/1"), (11, "http://a.org/en/1"), (None, "http://É.com/"), (12, "a://b://c.com/d"), (13, "http://?x"), (14, "http://a.com/\n/x")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.index(c) for c in "?#" if c in path] + [len(path)])]


def listed(host, path):
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'c' AS host", "'c' AS tokens", "'c' AS key", "'c' AS rule")
    return make


def test_hosts_paths_and_listed_rules(spark, pages):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    got = sorted((tuple(r)[:4] for r in urls.judge(pages(URLS), rules).collect()), key=str)
    assert got == sorted(((i, *parts(u), listed(*parts(u))[0]) for i, u in URLS), key=str)
    assert urls.judge(pages([]), rules).count() == 0


def test_query_against_brute_force(spark):
    """All association rules by counting every subset of tokens, pruned and matched one by one."""
    folder = "/root/testdata/sf0.001"
    rows = queries.read(spark, folder, "pages").select("page_id", "url", urls.tokens(F.col("url")).alias("tokens")).collect()
    seen = {}
    for u, t in {(r["url"], tuple(r["tokens"])) for r in rows}:
        rule, verdict = listed(*parts(u))
        if rule:
            seen[t, verdict] = seen.get((t, verdict), 0) + 1
    total, counts, both = sum(seen.values()), {}, {}
    for (t, v), n in seen.items():
        for k in range(1, len(t) + 1):
            for c in combinations(t, k):
                counts[c] = counts.get(c, 0) + n
                both[c, v] = both.get((c, v), 0) + n
    least = max(2, 0.002 * total)
    rules = {(c, v): (n / counts[c], n / total) for (c, v), n in both.items() if n >= least and n / counts[c] >= 0.8}
    kept = {(c, v): s for (c, v), s in rules.items()
            if not any(rules.get((d, v), (0, 0))[0] >= s[0] for d in combinations(c, len(c) - 1))}
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in queries.op9_urls(spark, folder).collect()}
    mined = 0
    for r in rows:
        rule, verdict = listed(*parts(r["url"]))
        if not rule:
            fits = [(s[0], s[1], len(c), v == "block", v) for (c, v), s in kept.items() if set(c) <= set(r["tokens"])]
            verdict = max(fits)[-1] if fits else "allow"
            mined += bool(fits)
        assert got[r["page_id"]] == (rule, verdict)
    assert mined > 10 and len(got) == len(rows)


def test_labelled_urls_decide(spark, pages):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    labelled = spark.createDataFrame([(f"http://h{i}.org/{'spam' if i % 2 else 'ham'}/{i}", "block" if i % 2 else "allow") for i in range(60)],
                                     "url string, verdict string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages([(1, "http://q.org/spam/9"), (2, "http://q.org/ham/9"), (3, "ftp://z")]),
                                                         rules, labelled).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow"}


def test_urls_of_many_tokens(spark, pages):
    """Tokens that always come together are one item, so no set of them is mined; a single labelled url makes no rule."""
    rules = spark.createDataFrame([("a.com", "/x", "block")], "host string, path string, verdict string")
    long = "/".join(f"segment-{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))
    one = [(1, f"http://a.com/x/{long}"), (2, f"http://b.com/{long}")]
    assert {r["page_id"]: r["verdict"] for r in urls.judge(pages(one), rules).collect()} == {1: "block", 2: "allow"}
    known = [(f"http://h{k}.org/{long}", "block") for k in range(3)] + [("http://good.org/fine", "allow")] * 3
    labelled = spark.createDataFrame(known, "url string, verdict string")
    # Any token of the class will do.
    asked = [(1, "http://q.net/segment-bc/else"), (2, "http://q.net/fine"), (3, "http://q.net/none")]
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages(asked), rules, labelled).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow"}


def test_support_and_confidence_are_those_of_the_urls(spark):
    """One token set of very many blocked urls against many sets of a few allowed ones that share its path token."""
    rows = [(["host:spam", "path:p"], "block", 1_200_000)] + [([f"host:h{i}", "path:p"], "allow", 2) for i in range(1500)]
    known = spark.createDataFrame(rows, "tokens array<string>, verdict string, n long")
    got = {(tuple(r["tokens"]), r["verdict"]): (r["confidence"], r["support"]) for r in urls.mine(known).collect()}
    n = 1_200_000
    assert got[("path:p",), "block"] == pytest.approx((n / (n + 3000), n / (n + 3000)))
    assert got[("host:spam",), "block"] == pytest.approx((1.0, n / (n + 3000)))
    assert not any(v == "allow" for _, v in got)
