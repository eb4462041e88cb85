"""From free-text tags to genre scores: normalising, bucketing, the weighted vote, coverage and distinctiveness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary
from ..functions.names import ratio
from ..functions.text import clean_tag, tag_weight
from ..params import DEFAULTS, Params


def bucket_table(spark, buckets: list[str] | None = None) -> DataFrame:
    """(bucket, priority)"""
    return spark.createDataFrame([(b.lower(), i) for i, b in enumerate(buckets or vocabulary.BUCKETS)], "bucket string, priority int")


def keyword_table(spark, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """(keyword, bucket, priority)"""
    return spark.createDataFrame([(k, b, i) for i, (k, b) in enumerate(vocabulary.KEYWORDS if rules is None else rules)], "keyword string, bucket string, priority int")


def alias_table(spark) -> DataFrame:
    """(tag, alias)"""
    return spark.createDataFrame(sorted(vocabulary.ALIASES.items()), "tag string, alias string")


def near_pairs(texts: DataFrame, terms: DataFrame, threshold: int) -> DataFrame:
    """(text, term, priority): pairs that may have a normalised Indel similarity of ``threshold``; none that has is left out.

    A similarity bounds the number of insertions and deletions between two lengths. A term is cut in one segment more
    than its greatest such number, so one segment stands whole in every text that is near enough, and it is shifted by no
    more than what is inserted or deleted before it. Segments by length, number and wording are the key, texts bring the
    pieces at the places where each segment can be: the join meets nothing that doesn't share a piece at its place.
    Terms too short for that meet the texts of every length that is near enough.
    """
    a, b, left = F.length("text"), F.length("term"), 100 - threshold
    longest = lambda n: F.floor(n * (200 - threshold) / threshold).cast("int")
    segments = lambda n: (F.floor(left * (n + longest(n)) / 100) + 1).cast("int")
    start = lambda i, n, k: F.floor(i * n / k).cast("int")
    n, k, i = F.col("size"), F.col("k"), F.col("i")
    cut = terms.select("term", "priority", b.alias("size")).where("size > 0").withColumn("k", segments(n))
    first, end = start(i, n, k), start(i + 1, n, k)
    held = cut.where("k <= size").select("*", F.explode(F.sequence(F.lit(0), k - 1)).alias("i")).select("term", "priority", "size", "i", F.substring("term", first + 1, end - first).alias("piece"))

    sizes = F.sequence(F.ceil(a * threshold / (200 - threshold)).cast("int"), longest(a))
    asked = texts.where(a > 0).select("text", F.explode(sizes).alias("size")).withColumn("k", segments(n))
    room = F.floor(left * (a + n) / 100)
    inserted, deleted = F.floor((room + a - n) / 2).cast("int"), F.floor((room - a + n) / 2).cast("int")
    placed = asked.where("k <= size").select("*", F.explode(F.sequence(F.lit(0), k - 1)).alias("i"))
    shifted = placed.select("text", "size", "i", first.alias("first"), (end - first).alias("wide"), F.explode(F.sequence(-deleted, inserted)).alias("shift"))
    pieces = shifted.where((F.col("first") + F.col("shift") >= 0) & (F.col("first") + F.col("shift") + F.col("wide") <= a))
    pieces = pieces.select("text", "size", "i", F.substring("text", F.col("first") + F.col("shift") + 1, F.col("wide")).alias("piece")).distinct()
    near = pieces.join(held, ["size", "i", "piece"]).select("text", "term", "priority").distinct()
    short = asked.where("k > size").join(cut.where("k > size").select("term", "priority", "size"), "size").select("text", "term", "priority")
    within = F.floor(left * (a + b) / 100).cast("int")
    return near.unionByName(short).where(F.call_function("levenshtein", F.col("text"), F.col("term"), within) >= 0)


def nearest_terms(texts: DataFrame, terms: DataFrame, threshold: int) -> DataFrame:
    """(text, term, score): the most similar term of at least ``threshold``, the first in order among equals.

    ``texts`` are distinct. Of the candidates only those within the Levenshtein distance that the similarity allows, which
    is built in, are scored exactly, in Arrow batches.
    """
    scored = near_pairs(texts, terms, threshold).withColumn("score", ratio("text", "term")).where(F.col("score") >= threshold)
    best = scored.groupBy("text").agg(F.max(F.struct("score", (-F.col("priority")).alias("o"), "term")).alias("b"))
    return best.select("text", F.col("b.term").alias("term"), F.col("b.score").alias("score"))


def normalised_tags(tags: DataFrame, canonical: DataFrame | None = None, aliases: DataFrame | None = None, params: Params = DEFAULTS) -> DataFrame:
    """(tag, genre) for the distinct values of ``tags.tag``: junk gives null, then alias, then nearest canonical term, then itself.

    ``canonical`` has (term, priority).
    """
    spark = tags.sparkSession
    aliases = alias_table(spark) if aliases is None else aliases
    distinct = tags.select("tag").distinct().withColumn("text", clean_tag(F.col("tag")))
    named = distinct.join(aliases.select(F.col("tag").alias("text"), "alias"), "text", "left")
    if canonical is None:
        return named.select("tag", F.coalesce("alias", "text").alias("genre"))
    open_texts = named.where("alias is null and text is not null").select("text").distinct()
    exact = open_texts.join(canonical.select(F.col("term").alias("text")), "text", "left_semi").withColumn("term", F.col("text"))
    near = nearest_terms(open_texts.join(exact, "text", "left_anti"), canonical, params.fuzzy_canonical).select("text", "term")
    return named.join(exact.unionByName(near), "text", "left").select("tag", F.coalesce("alias", "term", "text").alias("genre"))


def bucketed(genres: DataFrame, buckets: DataFrame | None = None, keywords: DataFrame | None = None, fuzzy: bool = True, params: Params = DEFAULTS) -> DataFrame:
    """(genre, bucket) for the distinct values of ``genres.genre``: exact, longest contained bucket, first keyword, nearest bucket, else other.

    A text that contains a name contains its first three letters: names and texts join on those, then containment is tested.
    """
    spark = genres.sparkSession
    buckets = bucket_table(spark) if buckets is None else buckets
    keywords = keyword_table(spark) if keywords is None else keywords
    distinct = genres.select("genre").distinct().withColumn("text", clean_text())
    rules = buckets.select(F.col("bucket").alias("part"), "bucket", F.lit(1).alias("tier"), (-F.length("bucket")).alias("size"), "priority").unionByName(
        keywords.select(F.col("keyword").alias("part"), "bucket", F.lit(2).alias("tier"), F.lit(0).alias("size"), "priority")
    )
    head = rules.where("part <> ''").withColumn("head", F.substring("part", 1, 3))
    ends = F.transform(F.sequence(F.lit(1), F.length("text")), lambda i: F.array(*[F.substring("text", i, F.lit(n)) for n in (1, 2, 3)]))
    heads = distinct.where("text <> ''").select("genre", "text", F.explode(F.array_distinct(F.flatten(ends))).alias("head"))
    met = heads.join(head, "head").where(F.col("text").contains(F.col("part")))
    tier = F.when(F.col("text") == F.col("bucket"), F.when(F.col("tier") == 1, 0).otherwise(2)).otherwise(F.col("tier"))
    best = met.groupBy("genre").agg(F.min_by("bucket", F.struct(tier.alias("tier"), "size", "priority")).alias("found"))
    out = distinct.join(best, "genre", "left")
    if fuzzy:
        left = out.where("found is null and text <> ''").select("text").distinct()
        near = nearest_terms(left, buckets.select(F.col("bucket").alias("term"), "priority"), params.fuzzy_bucket)
        out = out.join(near.select("text", "term"), "text", "left")
    else:
        out = out.withColumn("term", F.lit(None).cast("string"))
    return out.select("genre", F.coalesce("found", "term", F.lit(vocabulary.OTHER)).alias("bucket"))


def clean_text():
    return F.lower(F.regexp_replace(F.coalesce("genre", F.lit("")), r"(?U)^\s+|\s+$", ""))


def classified(tags: DataFrame, canonical: DataFrame | None = None, buckets: DataFrame | None = None, keywords: DataFrame | None = None, fuzzy: bool = True, params: Params = DEFAULTS, values: DataFrame | None = None) -> DataFrame:
    """``tags`` (country_code, artist_name, pos, tag, count, source) with genre (bucket, null for junk) and weight.

    Only an artist's first tags of a source count. Tags are resolved once for each distinct value and joined back; a table
    ``values`` (tag) that has all of them saves looking for them among the rows.
    """
    first = tags.where(F.col("pos") < params.tags_per_artist)
    named = normalised_tags(first if values is None else values, canonical, params=params)
    placed = bucketed(named.where("genre is not null").select("genre"), buckets, keywords, fuzzy, params)
    lookup = named.join(placed, "genre", "left").select("tag", "bucket")
    return first.join(lookup, "tag", "left").withColumn("weight", tag_weight(F.col("count"), params.tag_weight_divisor))


def _voting(classified_tags: DataFrame) -> DataFrame:
    return classified_tags.where(F.col("bucket").isNotNull() & (F.col("bucket") != vocabulary.OTHER)).withColumnRenamed("bucket", "genre")


def vote(classified_tags: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted vote per group and genre: score and sorted sources."""
    return _voting(classified_tags).groupBy(*keys, "genre").agg(F.sum("weight").alias("score"), F.array_sort(F.collect_set("source")).alias("sources"))


def behind(classified_tags: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, genre, artist_name): the artists behind each genre, one row each, so that no group gathers them all."""
    return _voting(classified_tags).select(*keys, "genre", "artist_name").distinct()


def coverage(classified_tags: DataFrame, keys: list[str]) -> DataFrame:
    """Tags in all, unclassified ones (junk or other) and their rate."""
    lost = F.col("bucket").isNull() | (F.col("bucket") == vocabulary.OTHER)
    out = classified_tags.groupBy(*keys).agg(F.count("*").alias("total_tags"), F.count_if(lost).alias("unclassified_tags"))
    return out.withColumn("unclassified_rate", F.round(F.coalesce(F.try_divide("unclassified_tags", "total_tags"), F.lit(0.0)), 4))


def quality_report(rates: DataFrame, artists: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """One row: countries, their mean rate, the empty ones and those above the alarm, worst first.

    ``rates`` is ``coverage`` by country, ``artists`` has (country_code, artist_count) for every country.
    """
    rated = artists.join(rates, "country_code", "left")
    alarm = (F.col("total_tags") > 0) & (F.col("unclassified_rate") > params.unclassified_alarm)
    bad = F.sort_array(F.collect_list(F.when(alarm, F.struct((-F.col("unclassified_rate")).alias("r"), "country_code"))))
    return rated.agg(
        F.count("*").alias("countries"),
        F.round(F.coalesce(F.avg(F.when(F.col("total_tags") > 0, F.col("unclassified_rate"))), F.lit(0.0)), 4).alias("average_rate"),
        F.array_sort(F.collect_list(F.when(F.col("artist_count") == 0, F.col("country_code")))).alias("empty_countries"),
        F.transform(bad, lambda x: x["country_code"]).alias("poorly_classified"),
    )


def shares(scores: DataFrame, keys: list[str]) -> DataFrame:
    """``scores`` with each genre's share of its group; groups without a positive total are left out."""
    total = F.sum("score").over(Window.partitionBy(*keys))
    return scores.withColumn("total", total).where("total > 0").withColumn("share", F.col("score") / F.col("total"))


def document_frequency(scores: DataFrame, keys: list[str], min_share: float = DEFAULTS.present_share) -> DataFrame:
    """In how many groups a genre has at least ``min_share``."""
    return shares(scores, keys).where(F.col("share") >= min_share).groupBy("genre").agg(F.count("*").alias("df"))


def distinctiveness(scores: DataFrame, keys: list[str], params: Params = DEFAULTS) -> DataFrame:
    """``scores`` with score * ln(N / df): N groups that contribute; 0 below the share floor and for genres without df.

    Two aggregates meet the rows again: genres are few, the number of groups is one row.
    """
    frequency = document_frequency(scores, keys, params.present_share)
    groups = scores.agg(F.count_distinct(*keys).alias("n"))
    totals = scores.groupBy(*keys).agg(F.sum("score").alias("total"))
    placed = scores.join(frequency, "genre", "left").join(totals, keys).crossJoin(F.broadcast(groups))
    promoted = (F.try_divide("score", "total") >= params.promoted_share) & (F.col("total") > 0) & (F.col("df") > 0)
    value = F.when(promoted, F.round(F.col("score") * F.ln(F.col("n") / F.col("df")), 3)).otherwise(F.lit(0.0))
    return placed.withColumn("distinctiveness", value).drop("df", "total", "n")
