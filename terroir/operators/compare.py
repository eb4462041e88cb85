"""Comparing countries by their genre shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import half_up, share_band
from ..params import DEFAULTS


def overlap_all(percentages: DataFrame) -> DataFrame:
    """(country_a, country_b, similarity): histogram intersection of every two countries that share a genre.

    ``percentages`` has (country_code, genre, percentage). The join is on the genre; countries per genre bound it.
    """
    a = percentages.select("genre", F.col("country_code").alias("country_a"), F.col("percentage").alias("l"))
    b = percentages.select("genre", F.col("country_code").alias("country_b"), F.col("percentage").alias("r"))
    both = a.join(b, "genre").where("country_a < country_b")
    return both.groupBy("country_a", "country_b").agg(half_up(F.round(F.sum(F.least("l", "r")), 6)).alias("similarity"))


def differences(percentages: DataFrame, left: str, right: str, limit: int = 10) -> DataFrame:
    """(genre, left, right, diff): the genres that differ most between two countries, in percentage points."""
    a = percentages.where(F.col("country_code") == left).select("genre", F.col("percentage").alias("l"))
    b = percentages.where(F.col("country_code") == right).select("genre", F.col("percentage").alias("r"))
    met = a.join(b, "genre", "full_outer").select("genre", F.coalesce("l", F.lit(0.0)).alias("left_pct"), F.coalesce("r", F.lit(0.0)).alias("right_pct"))
    diff = met.withColumn("diff", half_up(F.round(F.col("left_pct") - F.col("right_pct"), 6)))
    return diff.orderBy(F.abs("diff").desc(), "genre").limit(limit)


def leader_classes(top_genres: DataFrame, palette: int = 12) -> DataFrame:
    """(country_code, class): the class of the genre that leads a country, the most common leaders first.

    ``top_genres`` has (country_code, genre), one row per country. Leading genres are at most as many as countries, so one
    task ranks them.
    """
    counts = top_genres.where("genre is not null").groupBy("genre").count()
    place = F.row_number().over(Window.orderBy(F.desc("count"), "genre")) - 1
    classes = counts.select("genre", (place % palette).cast("int").alias("class"))
    return top_genres.join(classes, "genre", "left").select("country_code", "class")


def domestic_classes(domestic: DataFrame, min_coverage: float = DEFAULTS.min_coverage) -> DataFrame:
    """(country_code, class): the band of the domestic share; null where too little is classified."""
    return domestic.select("country_code", F.when(F.col("coverage_percentage") >= min_coverage, share_band(F.col("domestic_percentage"))).alias("class"))
