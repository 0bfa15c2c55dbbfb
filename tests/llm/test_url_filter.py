import re

import pytest

from dimstar.llm.queries import URL_RULES
from dimstar.llm.url_filter import filter_urls

URLS = [
    None,
    "",
    "no scheme/en/",
    "http://Www.Example.COM/en/1",
    "http://example.com/en/1?x=1&y=2",
    "http://notexample.com/en/1",
    "http://a.b.example.com/en/",
    "https://example.com",
    "https://example.com?q=/en/",
    "http://x.net/es/9#top",
    "http://x.net/fr",
    "http://net/fr/",
    "http://x.org/fr/1",
    "ftp://Ü.com/a://b",
    "http://é.net/es/" + "1" * 5000,
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_of(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)]
    rows += [(1000 + i, f"http://site{i % 7}.example.com/de/{i}", "x") for i in range(60)]
    rows += [(2000 + i, f"http://shop{i % 5}.net/es/{i}?a={i}&b=2&c=3", "x") for i in range(60)]
    rows += [(3000, "http://unknown.org/de/1", None), (3001, "http://more.net/de/7?a=1&b=2", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    return {r["page_id"]: r for r in filter_urls(pages, URL_RULES).collect()}


def test_hosts_paths_and_rules(judged):
    for i, url in enumerate(URLS):
        host, path = split(url)
        rule = rule_of(host, path)
        got = judged[i]
        assert (got["host"], got["path"]) == (host, path), url
        assert got["rule"] == (rule and rule.text)
        if rule:
            assert got["verdict"] == rule.verdict
        else:
            assert got["verdict"] in ("allow", "block") and 0 <= got["block_score"] <= 1


def test_trees_learn_from_labelled_urls(judged):
    assert judged[3000]["verdict"] == "allow"
    assert judged[3001]["verdict"] == "block"


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    assert filter_urls(none, URL_RULES).first()["verdict"] == "allow"
    one = spark.createDataFrame([(1, "http://x.org/"), (2, "http://y.net/es/")], "page_id long, url string")
    assert {r["verdict"] for r in filter_urls(one, URL_RULES).collect()} == {"block"}
    assert filter_urls(one.where("false"), URL_RULES).count() == 0
