"""URL filters against a plain Python version."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from pricefold.llm import url_filter as u

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
URLS = [
    "http://A.Example.NET/en/1", "https://x.example.net/de/1?a=b", "http://notexample.net/en/5", "http://example.com/de/7", "http://b.example.com/de", "http://q.org/fr/8#x",
    "http://q.org/FR/8", "mailto:me@x.net", None, "", "http://", "http://host", "http://HÖST.net/ä", "http://a.com/page.html?utm_source=f&z=1&a=2#t", "https://www.a.com/page/?a=2&z=1",
    "x://y://z.net/", "http://a.com/p?x=http://b.net/q", "http://listed.com/a", "https://m.listed.com/a.html#b",
]


def plain(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r, _ in RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fit, key=len, default=None)


def test_judges_as_the_plain_version_does(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("HOST", F.lit("old"))
    listed = spark.createDataFrame([("listed.com/a",), ("listed.com/a",), (None,), ("b.net/q",)], "canonical string")
    got = {r.page_id: r for r in u.judge_urls(pages, listed, RULES).collect()}
    assert len(got) == len(URLS)
    verdicts = dict(RULES)
    for i, url in enumerate(URLS):
        host, path, rule = plain(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].listed == (url in ("http://listed.com/a", "https://m.listed.com/a.html#b"))
        assert got[i].verdict == (verdicts[rule] if rule else "block" if got[i].listed else "allow")


def test_one_block_means_false_positives_but_right_results(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.com/"), "id").alias("url"))
    listed = spark.range(0, 3000, 3).select(F.concat(F.lit("a.com/"), "id").alias("canonical"))
    out = u.judge_urls(pages, listed, RULES, n_blocks=1)
    assert out.where("listed").count() == 1000 and out.where("verdict = 'block'").count() == 1000


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    listed = spark.createDataFrame([], "canonical string")
    assert u.judge_urls(pages, listed, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert u.judge_urls(one.union(one), listed, RULES).where("verdict = 'allow'").count() == 2
