"""Links, sitemaps, location blocks and mail domains from texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricefold.functions import expressions as X


def anchors(pages: DataFrame) -> DataFrame:
    """(page_id, url, at, href, text) of every link, in order; relative ones resolved against the page."""
    tag = r'(?is)<a\s+[^>]*?href\s*=\s*["\']([^"\']+)["\'][^>]*>(.*?)</a>'
    df = pages.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(tag), F.lit(0))).alias("at", "a"))
    href, text = F.regexp_extract("a", tag, 1), F.trim(F.regexp_replace(F.regexp_extract("a", tag, 2), r"<[^>]+>", " "))
    origin = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*", 0)
    base = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), r"(://[^/]*.*/)[^/]*$", "$1")
    resolved = X.choose([(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), href), (href.startswith("//"), F.concat(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*:", 0), href)), (href.startswith("/"), F.concat(origin, href)), (href.startswith("#"), F.lit(None))], F.concat(base, href))
    return df.select("page_id", "url", "at", resolved.alias("href"), text.alias("text")).where("href IS NOT NULL AND NOT lower(href) LIKE 'mailto:%'")


def harvest_links(pages: DataFrame, least: int = 3) -> DataFrame:
    """(page_id, href, score): links to likely price files, the best score of each URL of a page."""
    df = anchors(pages).withColumn("score", X.score_link(F.col("href"), F.col("text"))).where((F.col("score") >= least) & ~X.is_web_asset(F.col("href")))
    return df.groupBy("page_id", "href").agg(F.max("score").alias("score"))


def top_links(links: DataFrame, k: int = 10) -> DataFrame:
    w = Window.partitionBy("page_id").orderBy(F.desc("score"), "href")
    return links.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def harvest_sitemap(sitemaps: DataFrame, least: int = 3) -> DataFrame:
    """(page_id, href, score) of the <loc> entries of sitemaps (page_id, xml)."""
    df = sitemaps.select("page_id", F.explode(F.regexp_extract_all("xml", F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1))).alias("href"))
    return df.withColumn("score", X.score_link(F.col("href"), F.lit(""))).where(F.col("score") >= least).groupBy("page_id", "href").agg(F.max("score").alias("score"))


def location_blocks(texts: DataFrame) -> DataFrame:
    """(id, at, name, url, page, email) of blocks of ``key: value`` lines, parted by blank lines; a block needs URL and name."""
    blocks = texts.select("id", F.posexplode(F.split("text", r"\r?\n\s*\r?\n")).alias("at", "block"))
    pairs = F.filter(F.transform(F.split("block", r"\r?\n"), lambda x: F.struct(F.lower(F.trim(F.regexp_extract(x, r"^\s*([^:]+):", 1))).alias("k"), F.trim(F.regexp_extract(x, r"^\s*[^:]+:\s*(.*)$", 1)).alias("v"))), lambda p: p["k"] != "")
    df = blocks.withColumn("pairs", pairs)
    value = lambda k: F.try_element_at(F.filter("pairs", lambda p: p["k"] == k), F.lit(1))["v"]
    df = df.select("id", "at", value("location-name").alias("name"), value("mrf-url").alias("url"), value("source-page-url").alias("page"), value("contact-email").alias("email"))
    return df.where((F.coalesce("url", F.lit("")) != "") & (F.coalesce("name", F.lit("")) != ""))


def email_domains(texts: DataFrame, ignored: tuple[str, ...] = ("gmail.com", "yahoo.com", "outlook.com", "hotmail.com")) -> DataFrame:
    """(domain, n, first_id): domains of addresses in texts (id, text), without public mail services."""
    found = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9._%+\-]+@([A-Za-z0-9.\-]+\.[A-Za-z]{2,})"), F.lit(1)), F.lower))
    df = texts.select("id", F.explode(found).alias("domain")).where(~F.col("domain").isin(*ignored))
    return df.groupBy("domain").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


def candidate_domains(facilities: DataFrame) -> DataFrame:
    """(ccn, url) of the web addresses that facilities of these names might have."""
    return facilities.select("ccn", F.explode(X.name_domains(F.col("name"))).alias("url"))
