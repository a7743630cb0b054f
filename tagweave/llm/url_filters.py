"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join of its hits.

Main path: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm.common import ascii_lower

#: Host and path rules with their verdicts. A rule fits its host and all subdomains.
RULES = {
    "com/en/": "block",
    "example.com/en/7": "allow",
    "net/de/": "allow",
    "example.net/de/8": "block",
    "org/es/": "block",
}
#: Hosts, languages and page numbers that the standard list of pages is made of.
LISTED_HOSTS = ["cheap-pills.example.com", "casino-win.example.org", "free-bets.example.com", "spam-farm.example.org", "ads-track.example.org"]
LISTED_LANGS = ["en", "fr", "de", "es"]
LISTED_PAGES = 1000


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path up to ``? #``. Else both empty."""
    url, pattern = F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def canonical_url(host: Column, path: Column) -> Column:
    """One form for a page's variants: no scheme, query, fragment, leading ``www.``/``m.``/``blog.``, ``.html`` or last slash."""
    return F.concat(F.regexp_replace(host, r"^(www|m|blog)\.", ""), F.regexp_replace(path, r"(\.html|/)$", ""))


def listed_urls(spark: SparkSession) -> DataFrame:
    """The standard list: one canonical URL a row, made from a rule."""
    pages = spark.range(len(LISTED_HOSTS) * len(LISTED_LANGS) * LISTED_PAGES)
    hosts, langs = F.array(*map(F.lit, LISTED_HOSTS)), F.array(*map(F.lit, LISTED_LANGS))
    n = F.col("id")
    page, lang, host = n % LISTED_PAGES, F.floor(n / LISTED_PAGES) % len(LISTED_LANGS), F.floor(n / (LISTED_PAGES * len(LISTED_LANGS)))
    pick = lambda a, i: F.element_at(a, (i + 1).cast("int"))
    return pages.select(F.concat_ws("/", pick(hosts, host), pick(langs, lang), page.cast("string")).alias("url"))


def fitting_rule(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def bloom_key(url: Column, blocks: int) -> tuple[Column, Column]:
    """(block, mask): the 64-bit word that a URL falls to and its four bits there, from two independent hashes."""
    block, bits = F.pmod(F.xxhash64(F.lit("block"), url), F.lit(blocks)), F.xxhash64(F.lit("bits"), url)
    mask = F.lit(0).cast("long")
    for shift in (0, 6, 12, 18):
        bit = F.shiftrightunsigned(bits, shift).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return block, mask


def filter_urls(
    pages: DataFrame, listed: DataFrame, id_column: str = "page_id", url_column: str = "url",
    rules: dict[str, str] = RULES, bits_per_url: int = 16, broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """Judge each row's URL: the fitting rule's verdict, else ``block`` if its canonical form is listed.

    Args:
        pages: any rows with ``id_column`` and ``url_column``; other columns are not read.
        listed: canonical URLs in column ``url``; nulls and repeats don't matter.
        bits_per_url: size of the Bloom filter. 16 with 4 bits set let about 1 % pass by mistake;
            the exact join then removes those.
        broadcast_bytes: the filter and the list are broadcast only if their counted size is below this.
            Above it both joins shuffle, and URLs that the filter turns away get spread keys.

    Returns page_id, host, path, canonical, rule, possible (passed the Bloom filter), listed, verdict.
    Null or malformed URLs have empty host and path, no rule and verdict ``allow``; an empty URL in the list
    lists nothing. Of rules that fit the longest wins, of equally long ones the last in order. Repeated rows come out
    as often as they went in; null ids are judged like any other; an empty list or table gives the obvious result.
    Whatever is turned away, and rows without a host, get keys of their own, so they don't meet in one task.
    """
    exact = listed.select(F.col("url").cast("string").alias("k")).where("k <> ''").distinct()
    n, longest = exact.agg(F.count("*"), F.coalesce(F.max(F.octet_length("k")), F.lit(0))).first()
    blocks = max(1, n * bits_per_url // 64)
    held = lambda df, size: F.broadcast(df) if size <= broadcast_bytes else df

    block, mask = bloom_key(F.col("k"), blocks)
    words = exact.select(block.alias("block"), mask.alias("mask")).groupBy("block").agg(F.bit_or("mask").alias("word"))

    host, path = url_parts(pages[url_column].cast("string"))
    rows = pages.select(pages[id_column].alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("canonical", canonical_url(F.col("host"), F.col("path")))
    block, mask = bloom_key(F.col("canonical"), blocks)
    nowhere = F.bitwise_not(F.shiftrightunsigned(F.xxhash64("page_id", "host"), 1))
    block = F.when(F.col("canonical") == "", nowhere).otherwise(block)
    rows = rows.withColumns({"block": block, "mask": mask}).join(held(words, blocks * 32), "block", "left")
    rows = rows.withColumn("possible", F.coalesce(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False)))
    away = F.concat(F.lit("\0"), F.xxhash64("page_id", "host", "path").cast("string"))
    rows = rows.withColumn("k", F.when(F.col("possible"), F.col("canonical")).otherwise(away))
    rows = rows.join(held(exact.withColumn("hit", F.lit(True)), n * (longest + 32)), "k", "left")

    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    verdict = F.when(F.coalesce(F.col("hit"), F.lit(False)), "block").otherwise("allow")
    by_rule = F.coalesce(*[F.when(F.col("rule") == k, F.lit(v)) for k, v in rules.items()], verdict)
    return rows.withColumn("rule", rule).select(
        "page_id", "host", "path", "canonical", "rule", "possible", F.coalesce("hit", F.lit(False)).alias("listed"), by_rule.alias("verdict")
    )
