from __future__ import annotations

import pytest

from litscope.llm.queries import QUERIES, URL_RULES, oracles
from litscope.llm.url_rules import judge_urls


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if r[0] and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1] or "")]
    best = max(fits, key=lambda r: (len(r[0] + (r[1] or "")), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + (best[1] or ""), best[2] if best else default


URLS = [
    None, "", "no scheme", "http://", "http:///x", "http://ORG", "http://a.ORG/", "https://example.org/es/1", "https://x.example.org/es",
    "https://example.org/en/12?x=/es/", "https://notexample.org/es/", "http://a.com/fr/#/de/", "http://a.com/de/", "http://a.com/de", "x://y://b.com/fr/",
    "http://É.example.ORG/en/1", "http://a.com?/fr/", "http://user@a.com:80/fr/", "http://..com/fr/", "http://" + "a." * 3000 + "com/fr/" + "x" * 5000,
    "http://a.b/\n/x", "http://a.com/fr/é",
]


@pytest.mark.parametrize("extra", [[], [("", "/", "block"), (None, "/", "block"), ("a.com", None, "block"), ("a.com", "/f", "block"), ("com", "/fr/é", "block"), ("org", "/", "allow")]])
def test_edges(spark, extra):
    rules = URL_RULES + extra
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(0, None, "x"), (None, "http://a.com/de/", None)], "page_id bigint, url string, host string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = judge_urls(pages, frame)
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    rows = found.collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"], rules)
    assert judge_urls(pages.limit(0), frame).count() == 0
    assert {r["rule"] for r in judge_urls(pages, frame.limit(0), default="block").select("rule", "verdict").distinct().collect()} == {None}


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op10_url_rules"](spark, folder).collect()
    assert len(rows) == len(urls) and any(r["rule"] for r in rows)
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(urls[r["page_id"]], URL_RULES)


def test_oracles(spark):
    import sys

    sys.path.insert(0, "tests")
    from check_oracles import compare, duck

    folder = "/root/testdata/sf0.001"
    for name in oracles():
        good, note = compare(spark, duck(folder), folder, name)
        assert good, note
