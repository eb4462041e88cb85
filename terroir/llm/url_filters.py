"""URL filters: listed rules first, else association rules mined from labelled pages.

A page's URL becomes a set of tokens (host labels, path segments, query keys). Labelled pages are the transactions of
Spark's FP-growth. A rule "these tokens, so bad" stays if its support and its confidence are high enough and no rule
of fewer tokens already covers it. So a token that is a rule by itself leaves the transactions before they are mined, and
of tokens that the same labelled pages hold one stands for all, or else a family of URLs with thirty optional query keys
would have 2^30 frequent sets. Mined rules are taken from the shortest on, and only rules that stay are compared with
longer ones. For matching, every rule is filed under its rarest token: a URL looks up the rules of its own tokens and
checks the rest of each. All of it is DataFrame work.

Defined results: a null URL or one without ``://`` has an empty host and path, no tokens and the verdict allow; equal
URLs get equal verdicts, and repeated rows stay repeated; with fewer than ``LEAST_PAGES`` labelled pages there are no rules; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, small, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of rules that may be broadcast; beyond it the look-up shuffles.
BROADCAST_BYTES = 16 << 20
#: Share of the labelled pages that a rule's tokens and label must have in common, and how sure the rule must be.
#: In a small table the support is that of so many pages, else every combination of every URL would be frequent.
SUPPORT, CONFIDENCE, LEAST_PAGES = 0.001, 0.6, 20
BAD = "label=bad"

#: (verdict, host, path)
LISTED = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(name: Column, at: Column, rules: tuple = LISTED) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; both null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, owner, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((name == owner) | name.endswith("." + owner)) & at.startswith(start)
        rule, verdict = F.when(fits, owner + start).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens: host labels, path segments without numbers, query keys and fragment."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    parts = F.concat(
        F.transform(F.split(host(url), r"\."), lambda x: F.concat(F.lit("host="), x)),
        F.transform(F.split(path(url), "/"), lambda x: F.concat(F.lit("path="), F.regexp_replace(x, "[0-9]+", "#"))),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query="), F.regexp_extract(x, "^[^=]*", 0))),
    )
    return F.array_distinct(F.filter(parts, lambda x: ~x.endswith("=")))


def document(url: Column) -> Column:
    """The id of the page's document: the first all-digit path segment, with or without an extension."""
    return F.regexp_extract(path(url), r"/([0-9]{1,18})(?:\.[a-z]+)?(?:/|$)", 1).try_cast("bigint")


def mined(pages: DataFrame, labels: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame | None:
    """(rule_id, tokens, entry, confidence): the pruned rules, each with its rarest token as its entry; None if there are too few labelled pages."""
    told = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    bad = told.groupBy("doc_id").agg(F.max(F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit(False))).alias("bad"))
    seen = pages.select(document(F.col("url")).alias("doc_id"), tokens(F.col("url")).alias("items")).where(F.size("items") > 0)
    labelled = settle(seen.join(bad, "doc_id").withColumn("row", F.monotonically_increasing_id()))
    pages_told = labelled.count()
    if pages_told < LEAST_PAGES:
        return None
    least = math.ceil(max(support, LEAST_PAGES / pages_told) * pages_told)
    each = labelled.select("row", "bad", F.explode("items").alias("token"))
    mix = lambda seed: F.bit_xor(F.xxhash64("row", F.lit(seed)))
    held = settle(each.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("both"), mix(1).alias("x"), mix(2).alias("y")))
    same = held.where(F.col("n") >= least).groupBy("n", "x", "y").agg(F.min("token").alias("token"), F.first("both").alias("both"))
    chosen = settle(same.withColumn("confidence", F.col("both") / F.col("n")).withColumn("alone", (F.col("both") >= least) & (F.col("confidence") >= confidence)))
    rules = settle(chosen.where("alone").select(F.array("token").alias("tokens"), F.col("token").alias("entry"), "confidence"))
    rest = chosen.where("not alone").select("token")
    if rest.limit(2).count() > 1:
        rules = _longer(each, labelled, settle(rest), held, rules, least / pages_told, confidence)
    return rules.withColumn("rule_id", F.xxhash64("tokens"))


def _longer(each: DataFrame, labelled: DataFrame, tokens_left: DataFrame, held: DataFrame, rules: DataFrame, support: float, confidence: float) -> DataFrame:
    """``rules`` with those of two tokens and more out of ``tokens_left``."""
    items = each.join(small(tokens_left, 128, BROADCAST_BYTES), "token", "left_semi").groupBy("row").agg(F.collect_list("token").alias("items"))
    # pages without such tokens count as transactions too, so that the support is a share of all
    sets = labelled.select("row", "bad").join(items, "row", "left").select(F.concat(F.coalesce("items", F.array().cast("array<string>")), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(settle(sets))
    found = settle(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    with_bad = found.where(F.array_contains("items", BAD)).select(F.array_remove("items", BAD).alias("tokens"), F.col("freq").alias("both")).where(F.size("tokens") > 1)
    sure = with_bad.join(found, F.col("tokens") == F.col("items")).select("tokens", (F.col("both") / F.col("freq")).alias("confidence")).where(F.col("confidence") >= confidence)
    sure = settle(sure.withColumn("rule", F.monotonically_increasing_id()))
    rarest = sure.select("rule", F.explode("tokens").alias("token")).join(held.select("token", "n"), "token").groupBy("rule").agg(F.min(F.struct("n", "token"))["token"].alias("entry"))
    filed = settle(sure.join(rarest, "rule").select("rule", "tokens", "entry", "confidence"))
    for row in filed.select(F.size("tokens").alias("n")).distinct().orderBy("n").collect():  # as many as tokens of a URL
        mine = filed.where(F.size("tokens") == row.n)
        # a rule is spared if the tokens of one that stays are part of its own
        shorter = rules.select(F.col("tokens").alias("fewer"), "entry")
        spared = mine.select("rule", "tokens", F.explode("tokens").alias("entry")).join(shorter, "entry").where(F.size(F.array_except("fewer", "tokens")) == 0).select("rule").distinct()
        rules = settle(rules.unionByName(mine.join(spared, "rule", "left_anti").select("tokens", "entry", "confidence")))
    return rules


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct URLs (url) that a rule's tokens are part of, by the inverted index."""
    rules = settle(rules)
    looked = urls.select("url").distinct().select("url", tokens(F.col("url")).alias("own")).select("url", "own", F.explode("own").alias("entry"))
    return looked.join(small(rules, 512, BROADCAST_BYTES), "entry").where(F.size(F.array_except("tokens", "own")) == 0).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, listed_rules: tuple = LISTED, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Every page with its host, path, listed rule and verdict."""
    url = F.col("url")
    name, at = host(url), path(url)
    rule, said = listed(F.col("host"), F.col("path"), listed_rules)
    out = pages.select("page_id", "url", name.alias("host"), at.alias("path")).select("*", rule.alias("rule"), said.alias("said"))
    rules = mined(pages, labels, support, confidence)
    if rules is None:
        out = out.withColumn("hit", F.lit(None).cast("boolean"))
    else:
        hits = settle(matched(pages, rules).withColumn("hit", F.lit(True)))
        out = out.join(small(hits, 256, BROADCAST_BYTES), "url", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("hit"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels"))


QUERIES = {"op2_url_filters": op2_url_filters}
