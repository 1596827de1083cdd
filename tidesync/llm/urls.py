"""URL filters: given rules, then association rules mined from labelled URLs.

The given rules (host and path prefix, allow or block) decide first. For other
URLs, Spark's FP-growth mines sets of URL tokens (host, its parent and top
level domain, first label, path segments without their numbers, query keys,
fragment, scheme) that labelled URLs share with the label ``block``. Rules
under the least support (``MIN_COUNT`` blocked URLs, however many are labelled) or confidence go, and so do rules that a more general
rule with at least their confidence makes redundant. A rule matches a URL that
has all its tokens: an inverted index finds the rules of a URL by their rarest
token, then the other tokens are checked.

Distinct token sets are matched, not URLs, so repeated URLs cost nothing more.
Everything is DataFrame and SQL functions and the JVM's FP-growth.

Defined cases: null urls and urls without ``://`` have empty host and path and
no tokens, and are allowed; repeated pages each keep a row; no labelled URLs,
or an empty table, give no rules; null labels teach nothing; extra columns are
ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import land, table

#: Blocked URLs that a token set needs, at any number of labelled URLs.
MIN_COUNT = 20
MIN_CONFIDENCE = 0.7
BLOCK = "verdict:block"


class Rule(NamedTuple):
    """A host (with its subdomains), a path prefix and what to do."""

    verdict: str
    host: str
    path: str


#: The rules of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; null and no ``://`` give ''."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def decide(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest given rule that fits; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r.verdict, r)):  # the longest last, so outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, r.host + r.path).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL, sorted; numbers in the path count as such, not by value."""
    host, path, url = host_of(url), path_of(url), F.coalesce(url, F.lit(""))
    labels = F.split(host, r"\.")
    parent = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    segments = F.filter(F.split(F.regexp_replace(path, r"[0-9]+", "0"), "/"), lambda s: s != "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda q: F.regexp_extract(q, r"^([^=]*)", 1)), lambda k: k != "")
    one = lambda kind, value: F.when(value != "", F.array(F.concat(F.lit(kind + ":"), value))).otherwise(F.array().cast("array<string>"))
    many = lambda kind, values: F.transform(values, lambda v: F.concat(F.lit(kind + ":"), v))
    found = F.concat(
        one("host", host), one("parent", parent), one("top", F.element_at(labels, -1)), one("first", labels[0]),
        many("path", segments), many("key", keys), one("fragment", F.regexp_extract(url, "#(.*)", 1)),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(found)))


def mine(labelled: DataFrame, min_support: float = 0.0, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Block rules (tokens, anchor, confidence, support) from (url, blocked boolean); ``min_support`` asks for a share of the URLs beside ``min_count``."""
    baskets = labelled.where("blocked IS NOT NULL").select(tokens_of(F.col("url")).alias("tokens"), "blocked").where(F.size("tokens") > 0)
    baskets = land(baskets.select(F.when(F.col("blocked"), F.concat("tokens", F.array(F.lit(BLOCK)))).otherwise(F.col("tokens")).alias("items"), "blocked", F.monotonically_increasing_id().alias("n")), "url-baskets")
    spark = labelled.sparkSession
    schema = "rule_id long, tokens array<string>, anchor string, confidence double, support long"
    seen = baskets.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.col("blocked").cast("long")), F.lit(0)).alias("blocked")).first()
    least = max(min_count, min_support * seen.rows)
    if seen.blocked < least:
        return spark.createDataFrame([], schema)
    # No rule holds a token with fewer blocked URLs than a rule needs, so such tokens need not be mined.
    often = baskets.where("blocked").select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("met")).where(F.col("met") >= least)
    each = baskets.select("n", F.explode("items").alias("item")).join(often.select("item"), "item", "left_semi")
    baskets = land(each.groupBy("n").agg(F.collect_list("item").alias("items")), "url-frequent")
    share = (math.ceil(least) - 0.5) / baskets.count()  # half a URL less, as FPGrowth rounds the product up again
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=1.0).fit(baskets)
    sets = land(model.freqItemsets, "url-itemsets").withColumn("items", F.array_sort("items"))
    blocked = sets.where(F.array_contains("items", BLOCK) & (F.size("items") > 1))
    blocked = blocked.select(F.array_remove("items", BLOCK).alias("tokens"), F.col("freq").alias("support"))
    plain = sets.where(~F.array_contains("items", BLOCK)).select(F.col("items").alias("tokens"), F.col("freq").alias("met"))
    rules = blocked.join(plain, "tokens").withColumn("confidence", F.col("support") / F.col("met")).where(F.col("confidence") >= min_confidence)
    rarity = plain.where(F.size("tokens") == 1).select(F.col("tokens")[0].alias("token"), "met")
    each = rules.select("tokens", F.explode("tokens").alias("token")).join(rarity, "token")
    anchors = each.groupBy("tokens").agg(F.min(F.struct("met", "token")).alias("a")).select("tokens", F.col("a.token").alias("anchor"))
    rules = rules.join(anchors, "tokens").select(F.xxhash64("tokens").alias("rule_id"), "tokens", "anchor", "confidence", "support")
    rules = land(rules, "url-rules")
    # A rule is redundant beside one with fewer tokens, all of them its own, and at least its confidence.
    general = rules.select("anchor", F.col("tokens").alias("fewer"), F.col("confidence").alias("better"))
    wider = rules.select("rule_id", "tokens", "confidence", F.explode("tokens").alias("anchor")).join(general, "anchor")
    wider = wider.where((F.size("fewer") < F.size("tokens")) & (F.col("better") >= F.col("confidence")) & (F.size(F.array_except("fewer", "tokens")) == 0))
    return land(rules.join(wider.select("rule_id").distinct(), "rule_id", "left_anti"), "url-pruned")


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, confidence, matched) of the distinct token sets of ``urls`` that a rule matches: its best rule."""
    sets = urls.select("tokens").distinct()
    indexed = rules.select("anchor", F.col("tokens").alias("needed"), "confidence", "support")
    hits = sets.select("tokens", F.explode("tokens").alias("anchor")).join(indexed, "anchor")
    hits = hits.where(F.size(F.array_except("needed", "tokens")) == 0)
    best = hits.groupBy("tokens").agg(F.max(F.struct("confidence", "support", "needed")).alias("best"))
    return best.select("tokens", F.col("best.confidence").alias("confidence"), F.concat_ws(" ", "best.needed").alias("matched"))


def judge(pages: DataFrame, labelled: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the mined rule that blocked (``matched``) with its confidence."""
    urls = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), tokens_of(F.col("url")).alias("tokens"))
    found = matches(urls, mine(labelled))
    rule, verdict = decide(F.col("host"), F.col("path"), rules)
    judged = urls.withColumn("rule", rule).withColumn("given", verdict).join(found, "tokens", "left")
    mined = F.when(F.col("given").isNull(), F.col("matched"))
    return judged.select(
        F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule",
        F.coalesce("given", F.when(F.col("matched").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        mined.alias("matched"), F.when(mined.isNotNull(), F.col("confidence")).alias("confidence"),
    )


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs whose document (the number that ends the path) is labelled; bad or toxic documents are to be blocked."""
    pages = table(spark, sf_dir, "pages").select("url", F.expr(r"try_cast(regexp_extract(coalesce(url, ''), '/([0-9]{1,18})(?:[.]html)?/?(?:[?#]|$)', 1) AS bigint)").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    return pages.where("doc_id IS NOT NULL").join(labels, "doc_id").select("url", "blocked")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict."""
    return judge(table(spark, sf_dir, "pages"), labelled_urls(spark, sf_dir))
