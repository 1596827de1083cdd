"""URL filters: parsing, given rules, and mined rules against brute force."""

import itertools
import re
from collections import Counter

from tidesync.llm import urls

SF = "/root/testdata/sf0.01"


def plain_parts(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    if not m:
        return "", ""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]


def plain_rule(host, path):
    best = None
    for r in urls.RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            if best is None or len(r.host + r.path) > len(best.host + best.path):
                best = r
    return best


def plain_rules(baskets, min_count, min_confidence):
    """Every token set that blocks, with support and confidence, not redundant beside a smaller one."""
    met, hit = Counter(), Counter()
    for tokens, blocked in baskets:
        for n in range(1, len(tokens) + 1):
            for c in itertools.combinations(sorted(tokens), n):
                met[c] += 1
                hit[c] += blocked
    rules = {c: hit[c] / met[c] for c in met if hit[c] >= min_count and hit[c] / met[c] >= min_confidence}
    return {c for c, x in rules.items() if not any(set(d) < set(c) and y >= x for d, y in rules.items())}


def test_parsing_and_given_rules(spark):
    odd = [
        "http://Example.COM/en/1", "https://www.example.com/en/", "http://a.www.example.com/en/x", "http://net/es/", "HTTP://x.NET/fr/9?u=1#z", "no scheme",
        "", None, "http://", "http://h", "http://h?x", "http://h#y/z", "a://b://c/d", "http://notexample.com/en/", "http://x.org/es/", "http://ex.com/fr/", "http://É.com/",
    ]
    pages = spark.createDataFrame(list(enumerate(odd)), "page_id long, url string")
    got = urls.judge(pages, spark.createDataFrame([], "url string, blocked boolean")).collect()
    assert len(got) == len(odd)
    for r in got:
        host, path = plain_parts(odd[r.page_id])
        rule = plain_rule(host, path)
        assert (r.host, r.path) == (host, path)
        assert r.rule == (rule.host + rule.path if rule else None) and r.verdict == (rule.verdict if rule else "allow")


def labelled(spark):
    rows = []
    for k in range(60):
        rows.append((f"https://bad.example.org/en/{k}?utm=1", k % 10 != 0))
        rows.append((f"https://good.example.org/en/{k}", k % 10 == 0))
        rows.append((f"https://mix.example.org/de/{k}#top", k % 2 == 0))
        rows.append((f"https://mix.example.org/ads/{k}.html", True))
    return spark.createDataFrame(rows + [("x://y", None), (None, True)], "url string, blocked boolean")


def test_mined_rules_equal_brute_force(spark):
    data = labelled(spark)
    found = urls.mine(data, min_support=0.0, min_count=10, min_confidence=0.7).collect()
    baskets = [(r.t, r.blocked) for r in data.where("blocked IS NOT NULL").select(urls.tokens_of(data["url"]).alias("t"), "blocked").collect() if r.t]
    assert {tuple(r.tokens) for r in found} == plain_rules(baskets, 10, 0.7)
    assert all(r.anchor in r.tokens for r in found)


def test_least_count_is_the_same_among_many_labelled_urls(spark):
    rows = [(f"https://h{k % 1500}.example.org/en/{k}", False) for k in range(30_000)]
    rows += [(f"https://rare.example.net/de/{k}", True) for k in range(22)] + [(f"https://few.example.net/it/{k}", True) for k in range(19)]
    data = spark.createDataFrame(rows, "url string, blocked boolean")
    baskets = [(r.t, r.blocked) for r in data.select(urls.tokens_of(data["url"]).alias("t"), "blocked").collect()]
    found = {tuple(r.tokens) for r in urls.mine(data).collect()}
    assert found == plain_rules(baskets, urls.MIN_COUNT, urls.MIN_CONFIDENCE) and ("host:rare.example.net",) in found
    assert not any("few" in t for r in found for t in r)


def test_mined_rules_decide_urls_without_a_given_rule(spark):
    pages = spark.createDataFrame(
        [(1, "http://bad.example.org/fr/1"), (2, "http://good.example.org/fr/1"), (3, "http://mix.example.org/ads/77.html"), (3, "http://mix.example.org/ads/77.html"), (None, "http://bad.example.org/"), (5, "http://a.net/es/1")],
        "page_id long, url string",
    ).selectExpr("*", "'x' AS host", "'y' AS tokens", "'z' AS rule")
    rows = urls.judge(pages, labelled(spark)).collect()
    assert len(rows) == 6
    got = {(r.page_id, r.verdict) for r in rows}
    assert got == {(1, "block"), (2, "allow"), (3, "block"), (None, "block"), (5, "block")}
    assert all((r.matched is None) == (r.verdict == "allow" or r.rule is not None) for r in rows)


def test_query_on_whole_table(spark):
    rows = urls.op5_url_filters(spark, SF).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        rule = plain_rule(*plain_parts(pages[r.page_id]))
        assert (r.host, r.path) == plain_parts(pages[r.page_id])
        assert r.rule == (rule and rule.host + rule.path) and (rule is None or r.verdict == rule.verdict)


def test_no_pages_and_long_urls(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(none, labelled(spark)).count() == 0
    long_url = "http://h.org/" + "/".join(str(k) for k in range(5000))
    one = spark.createDataFrame([(1, long_url)], "page_id long, url string")
    assert urls.judge(one, labelled(spark)).first().path == long_url[len("http://h.org") :]
