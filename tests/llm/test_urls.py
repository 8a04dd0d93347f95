import re

import pytest

from demandframe.llm import url_filter as U

RULES = (U.SiteRule("block", "net", "/"), U.SiteRule("allow", "example.net", "/en/"), U.SiteRule("block", "b.org", "/x"))


def by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fit:
        r = max(fit, key=lambda r: len(r.text))
        return host, path, r.text, r.action
    words = re.split(r"[^a-z0-9]+", (host + " " + path).lower())
    return host, path, None, "block" if any(p.pattern.strip("^") in words for p in U.UNWANTED) else "allow"


URLS = [
    "http://a.net/", "http://A.NET", "https://x.example.net/en/1?q#f", "http://example.net/enx", "http://xnet/", "http://notb.org/x", "http://b.org/xyz", "http://casino.example.com/a",
    "http://e.com/free-bets/", "http://e.com/alphabets", "ftp://b.org?x", "no scheme", "", None, "http://a.net/", "http://é.net/ü", "://net/", "http://c.org/http://d.net/", "http://e.com/" + "a/" * 5000,
]


def test_against_hand(spark):
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    out = U.judge(df, RULES)
    assert out.columns[:4] == ["page_id", "url", "host", "rule"] and "_host" in out.columns and "_rule" in out.columns
    for r in out.collect():
        assert (r._host, r.path, r._rule, r.verdict) == by_hand(r.url), r.url


def test_pattern_without_a_whole_word_is_tried_everywhere(spark):
    df = spark.createDataFrame([("http://a.com/subscribe",), ("http://a.com/b",)], "url string")
    out = U.judge(df, (), (U.PatternRule("block", "scrib*"),))
    assert {r.url: r.verdict for r in out.collect()} == {"http://a.com/subscribe": "block", "http://a.com/b": "allow"}


@pytest.mark.parametrize("rule, words", [(U.SiteRule("block", "example.net", "/en/x"), ["en", "example", "net"]), (U.PatternRule("block", "^ads^"), ["ads"]), (U.PatternRule("block", "ads"), [""]), (U.PatternRule("block", "^a*b^"), [""])])
def test_words_that_index_a_rule(rule, words):
    assert U._tokens(rule) == words


def test_empty_table(spark):
    assert U.judge(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0
