"""URL verdicts against a plain loop over the list."""

import pytest

from starloom.llm import urls
from starloom.llm.queries import JUNK_NAMES, LISTED_HOSTS, QUERIES, URL_RULES


def _plain(url, rules, listed, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path.split("?")[0].split("#")[0]

    def best(entries):
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in entries if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit, key=lambda f: f[:2])[2:] if fit else (None, None)

    rule, verdict = best(rules)
    return host, path, rule, verdict or best(listed)[1] or default


CASES = [
    None, "", "no scheme", "http://", "://org/", "https://A.Example.ORG/es/x?y", "http://example.org/en/12#t", "http://example.org?x/en/1", "http://xexample.org/es/", "http://org", "http://org/",
    "ftp://a.b.com/fr/1", "http://com/de/", "http://.org/", "http://a..org/x", "http://m.free-bets.example.com/en/1", "http://free-bets.example.com", "http://u:p@x.com:80/de/", "a://b://c.org/d", "http://é.ORG/É\nz", "x" * 5000 + "://org/" + "p" * 50_000, "http://" + "a." * 3000 + "com/fr/",
]


def test_cases(spark):
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(CASES + CASES[5:8])], "page_id bigint, url string, rule string, host string")
    schema = "host string, path string, verdict string"
    rules, listed = spark.createDataFrame(URL_RULES + [(None, "/", "block"), ("org", None, "block")], schema), spark.createDataFrame([(h, "/", "block") for h in LISTED_HOSTS], schema)
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, rules, listed).collect()}
    spam = [(h, "/", "block") for h in LISTED_HOSTS]
    assert found == {k: _plain(u, URL_RULES, spam) for k, u in enumerate(CASES + CASES[5:8])}
    none = spark.createDataFrame([], schema)
    assert {r.verdict for r in urls.judge_urls(pages, none, none, "block").collect()} == {"block"}
    assert urls.judge_urls(pages.limit(0), rules, listed).count() == 0


def test_long_list_and_full_filter(spark):
    entries = [(f"h{k}.example.net", f"/{k % 7}" * (k % 3), "block" if k % 2 else "allow") for k in range(3000)]
    pages = spark.createDataFrame([(k, f"http://w.h{k}.example.net/{k % 5}/x") for k in range(4000)], "page_id bigint, url string")
    listed = spark.createDataFrame(entries, "host string, path string, verdict string")
    by_host = {h: (h, p, v) for h, p, v in entries}
    for blocks in (2048, 1):
        found = {(r.host, r.path): (r.rule, r.verdict) for r in urls.with_listing(pages, "url", listed, most_blocks=blocks).collect()}
        expected = {}
        for k in range(4000):
            host, path, rule, verdict = _plain(f"http://w.h{k}.example.net/{k % 5}/x", [by_host[f"h{k}.example.net"]] if k < 3000 else [], [], None)
            if rule is not None:
                expected[host, path] = (rule, verdict)
        assert found == expected


def test_filter_passes_few_strangers(spark):
    keys = spark.range(1000).selectExpr("concat('k', id) AS key")
    words = urls.bloom_filter(keys, "key", 32).scalar()
    assert keys.where(urls.may_hold(words, keys.key, 32)).count() == 1000
    others = spark.range(5000).selectExpr("concat('other', id) AS key")
    assert others.where(urls.may_hold(words, others.key, 32)).count() < 100


def test_whole_table(spark, small):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    spam = [(h, "/", "block") for h in LISTED_HOSTS]
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in QUERIES["op3_url_filters"](spark, small).collect()} == {k: _plain(u, URL_RULES, spam) for k, u in pages.items()}


def test_listed_entries_fit_the_canonical_form(spark):
    spam = ["http://pills.net:8080/", "http://me@pills.net/", "http://u:p@w.pills.net:80/x", "http://pills.net./", "http://p%69lls.NET/", "http://pills%2Enet%2e/a", "http://deals.net/b%61d/1", "http://deals.net/%zz/../", "http://deals.net/a+b"]
    fair = ["http://pills.net.org/", "http://pills.net@fair.org/", "http://xpills.net/", "http://deals.net/%62%61", "http://fair.org/?u=http://pills.net/"]
    pages = spark.createDataFrame(list(enumerate(spam + fair)), "page_id bigint, url string")
    schema = "host string, path string, verdict string"
    listed = spark.createDataFrame([("pills.net", "/", "block"), ("deals.net", "/bad", "block"), ("deals.net", "/%zz", "block"), ("deals.net", "/a+b", "block")], schema)
    found = {r.page_id: r for r in urls.judge_urls(pages, spark.createDataFrame([("com", "/", "allow")], schema), listed).collect()}
    assert [found[k].verdict for k in range(len(spam + fair))] == ["block"] * len(spam) + ["allow"] * len(fair)
    assert (found[2].host, found[6].path) == ("u:p@w.pills.net:80", "/b%61d/1")


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_no_junk_host_passes_unless_a_rule_allows_it(spark, folder):
    """Names of junk hosts in any spelling of host are blocked, and no other host is, but by a stated rule."""
    judged = QUERIES["op3_url_filters"](spark, f"/root/testdata/{folder}")
    rows = judged.where("rule IS NULL").select("host", "verdict").distinct().collect()
    junk = {r.host for r in rows if set(r.host.split(".")) & set(JUNK_NAMES)}
    assert junk and {r.host for r in rows if r.verdict == "block"} == junk
