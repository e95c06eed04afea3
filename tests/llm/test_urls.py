import re

import numpy as np
import pytest

from paylode.llm import bloom, urls

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"), ("a.net", "", "block"), ("b.a.net", "/x", "allow"), ("dup.net", "/", "allow"), ("dup.net", "/", "block")]
LISTED = ["spam.net/a", "spam.net", "Ünï.net/ä b", "listed.org/p"]
URLS = [None, "", "no scheme", "http://", "http://org/", "http://org", "https://x.Example.ORG/es/1", "http://example.org/en/12?q#f",
        "http://example.org/en/2", "http://notexample.org/es/", "http://a.com/fr/x", "http://a.com/de/", "http://com/de/x?u=http://b.com/fr/",
        "http://a.net", "http://c.b.a.net/xyz", "http://dup.net/y", "ftp://spam.net/a///", "http://SPAM.net/a?x=1", "http://spam.net/A",
        "http://spam.net", "http://spam.net//", "http://Ünï.net/ä b", "http://listed.org/p", "http://u@spam.net:80/a", "x://y.com#/fr/",
        "http://a..com/fr/", "http://.com/fr/", "http://a.com/fr/\nline"]


def by_force(url):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not match:
        return "", "", None, "allow"
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in match[1])
    path = match[2]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        best = max(fits)
        return host, path, best[2], best[3]
    return host, path, None, "block" if host + path.rstrip("/") in LISTED else "allow"


@pytest.mark.parametrize("most", [16 << 20, 64])
def test_verdicts_are_those_of_brute_force(spark, monkeypatch, most):
    """Also with a filter that is far too small, so that the join has to remove most of what it passes."""
    monkeypatch.setattr(bloom, "MOST_BYTES", most)
    filler = [f"filler{k}.example/{k}" for k in range(3000)]
    pages = spark.createDataFrame([*enumerate(URLS), (None, "http://spam.net/a"), (1, "http://spam.net/a")],
                                  "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS rule", "'z' AS key")
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    listed = spark.createDataFrame([(u,) for u in [*LISTED, *filler, None, LISTED[0]]], "url string")
    found = urls.judge(pages, rules, listed).collect()
    assert len(found) == len(URLS) + 2
    for r in found:
        url = URLS[r.page_id] if r.page_id is not None and r.host != "spam.net" else None
        if url is not None or r.page_id == 0:
            assert (r.host, r.path, r.rule, r.verdict) == by_force(url), url
    assert sorted(r.verdict for r in found if r.host == "spam.net" and r.path == "/a") == ["block"] * 3


def test_empty_lists_and_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    no_rules, no_urls = spark.createDataFrame([], "host string, path string, verdict string"), spark.createDataFrame([], "url string")
    assert [(r.rule, r.verdict) for r in urls.judge(pages, no_rules, no_urls).collect()] == [(None, "allow")] * 2
    assert urls.judge(pages.limit(0), no_rules, no_urls).count() == 0


def test_the_filter_passes_what_is_listed_and_little_else(spark):
    keys = spark.range(20_000).selectExpr("concat('k', id) AS key")
    words = bloom.build(keys, "key")
    probe = np.array([r[0] for r in spark.range(40_000).selectExpr("xxhash64(concat('k', id))").collect()])
    passed = bloom.passed(words, probe)
    assert passed[:20_000].all() and passed[20_000:].mean() < 0.01
    some = spark.range(40_000).selectExpr("concat('k', id) AS name").where(bloom.may_be_in(keys, "key", "name"))
    assert some.count() == passed.sum()
    assert spark.range(9).selectExpr("concat('k', id) AS name").where(bloom.may_be_in(keys.limit(0), "key", "name")).count() == 0
