"""Rules, canonical forms and the list against plain Python."""

from pyspark.sql import functions as F

from tierloom.llm import bloom, url_filter
from tierloom.llm.queries import RULES

URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1", "http://example.org/en/1680", "http://example.org/en/2", "http://a.b.example.org/es/",
    "http://badexample.org/es/", "http://notorg/x", "http://x.com/fr/1?x#y", "http://x.com/de/", "http://x.com/de", "http://net.example.net/a/?utm_source=1&b=2&a=1#f",
    "http://www.net.example.net/a?a=1&b=2", "http://net.example.net/a", "http://x.org?/es/", "x://y://z/", "http://ÄX.net/p",
]


def judged(rows, urls, listed):
    pages = rows("page_id long, url string, host string, key int", *[(i, u, "clash", 1) for i, u in enumerate(urls)])
    out = url_filter.judge(pages, RULES, rows("url string", *[(u,) for u in listed]))
    return {r["page_id"]: r for r in out.collect()}


def test_rules_and_hosts(rows):
    found = judged(rows, URLS, [])
    by_url = {u: found[i] for i, u in enumerate(URLS)}
    assert [by_url[u]["host"] for u in URLS[:4]] == ["", "", "", ""]
    assert (by_url["HTTP://WWW.Example.ORG/es/1"]["host"], by_url["HTTP://WWW.Example.ORG/es/1"]["rule"]) == ("www.example.org", "example.org/es/")
    rules = {u: by_url[u]["rule"] for u in URLS[5:]}
    assert rules["http://example.org/en/1680"] == "example.org/en/1"
    assert rules["http://example.org/en/2"] == "org/"
    assert rules["http://a.b.example.org/es/"] == "example.org/es/"
    assert rules["http://badexample.org/es/"] == "org/"
    assert rules["http://notorg/x"] is None and rules["http://x.org?/es/"] is None
    assert rules["http://x.com/fr/1?x#y"] == "com/fr/" and rules["http://x.com/de/"] == "com/de/" and rules["http://x.com/de"] is None
    assert by_url["x://y://z/"]["host"] == "y:" and by_url["http://ÄX.net/p"]["host"] == "Äx.net"
    assert by_url["http://x.com/de/"]["verdict"] == "block" and by_url["http://notorg/x"]["verdict"] == "allow"


def test_list_is_exact(rows):
    urls = [f"http://h{i % 50}.net/p{i}" for i in range(3000)] + ["http://h0.net/p0/#a"] * 500
    found = judged(rows, urls, ["https://www.h0.net/p0?utm_x=1", "http://h1.net/p1", "http://h1.net/p1", None, "bad"])
    assert {i for i, r in found.items() if r["verdict"] == "block"} == {0, 1, *range(3000, 3500)}
    assert len(found) == 3500


def test_rule_beats_list(rows):
    assert judged(rows, ["http://x.com/fr/1"], ["http://x.com/fr/1"])[0]["verdict"] == "allow"


def test_empty_tables(rows):
    pages = rows("page_id long, url string", (1, "http://a.net/")).limit(0)
    assert url_filter.judge(pages, RULES, rows("url string", ("http://a.net/",))).collect() == []
    assert judged(rows, ["http://a.net/"], [])[0]["verdict"] == "allow"


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    blocks = bloom.block_count(20_000)
    asked = spark.range(60_000).select(F.col("id").cast("string").alias("key"))
    found = bloom.probe(asked, "key", bloom.build(keys, "key", blocks), blocks).where("maybe").select(F.col("key").cast("long").alias("n"))
    assert found.where("n < 20000").count() == 20_000
    assert found.where("n >= 20000").count() < 400


def test_shuffled_tables_give_the_same(rows, monkeypatch):
    """Neither filter nor confirmed URLs are broadcast, hot URLs and repeated ids are dealt to several parts."""
    urls = [f"http://h{i % 50}.net/p{i}" for i in range(800)] + ["http://h0.net/p0/#a"] * 500 + [None] * 300
    listed = ["http://h0.net/p0", "http://h1.net/p1", "http://h7.org/p7"]
    plain = {i: tuple(r) for i, r in judged(rows, urls, listed).items()}
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(url_filter, "ROWS_PER_PART", 40)
    monkeypatch.setattr(bloom, "BROADCAST_BYTES", 0)
    assert {i: tuple(r) for i, r in judged(rows, urls, listed).items()} == plain
    repeated = rows("page_id long, url string", *[(None, "http://h0.net/p0")] * 300)
    out = url_filter.judge(repeated, RULES, rows("url string", ("http://h0.net/p0",))).collect()
    assert len(out) == 300 and {r["verdict"] for r in out} == {"block"}


def test_rows_that_ask_nothing_are_spread_over_blocks(spark):
    asked = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("key"))
    blocks = asked.select("key", bloom._asked_block(F.col("key"), 10).alias("b")).collect()
    assert {r["b"] for r in blocks if r["key"] is not None} <= set(range(10))
    silent = [r["b"] for r in blocks if r["key"] is None]
    assert max(silent) < 0 and len(set(silent)) > 500


def test_list_of_link_pages(rows):
    pages = rows("url string, html string", ("a", "<a x>1</a>" + "t" * 180), ("b", "<a x>1</a>" + "t" * 160), ("c", None), ("d", ""), ("e", "<A x><abbr>"), ("b", "<a x>"))
    assert sorted(r["url"] for r in url_filter.urls_of_link_pages(pages, 180).collect()) == ["b", "b"]


def test_a_very_long_url_and_repeated_rows(rows):
    long = "http://long.net/" + "p" * 200_000 + "?" + "&".join(f"k{i}=1" for i in range(2000))
    found = judged(rows, [long, long + "#x", long + "&utm_a=1", "http://long.net/p"], [long])
    assert [found[i]["verdict"] for i in range(4)] == ["block", "block", "block", "allow"]


def test_the_list_cannot_be_told_from_the_url(spark, sf_dir):
    """Listed and other pages have the same hosts and paths, but for numbers."""
    from tierloom.llm.queries import CHARACTERS_PER_LINK
    from tierloom.llm.shared import read

    pages = read(spark, sf_dir, "pages")
    listed = {r["url"] for r in url_filter.urls_of_link_pages(pages, CHARACTERS_PER_LINK).collect()}
    endings = lambda urls: {u.split("/")[2].rsplit(".", 2)[-2] for u in urls}
    others = {r["url"] for r in pages.collect()} - listed
    assert listed and others and endings(listed) <= endings(others)
