"""URL filter: hosts, paths and rules against a plain Python version; the trees on what rules leave open."""

from __future__ import annotations

import re

from histora.llm.url_filter import RULES, judge_urls

URLS = ["http://a.example.com/en/1", "https://www.example.com/en/x?q=1", "http://EXAMPLE.com/en/", "http://notexample.com/en/",
        "http://a.net/es/1", "http://a.net/fr/", "http://a.net/de/", "nothing here", "://", "http://x.com", "http://x.com?y=/en/",
        "http://h.org/a#b", "a://b://c.net/es/x", "http://b.www.example.com/en/9", None, "", "http://net/es/?a&b"]


def plain(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best.name if best else None, best.verdict if best else None


def test_rules_equal_the_plain_version(spark):
    pages = spark.createDataFrame([(i, u, "x", 1.0) for i, u in enumerate(URLS)],
                                  "page_id bigint, url string, host string, f_length double")
    got = {r["page_id"]: r for r in judge_urls(pages).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = plain(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")


def test_trees_learn_a_lexical_difference(spark):
    rows = [(i, f"http://h{i % 7}.example.com/en/{i}?a={i}&b=2&c=3") for i in range(300)]
    rows += [(1000 + i, f"http://h{i % 7}.shop.com/p") for i in range(300)]
    rows += [(5000, "http://h1.shop.org/p"), (5001, "http://h2.example.org/en/77?a=77&b=2&c=3")]
    got = {r["page_id"]: r for r in judge_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert got[5000]["rule"] is None and got[5000]["verdict"] == "allow" and got[5001]["verdict"] == "block"


def test_one_class_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a.net/es/1"), (2, "http://a.org/x")], "page_id bigint, url string")
    assert {r["verdict"] for r in judge_urls(pages).collect()} == {"block"}
    assert judge_urls(pages.limit(0)).collect() == []
    assert [r["verdict"] for r in judge_urls(pages.where("page_id = 2")).collect()] == ["allow"]
