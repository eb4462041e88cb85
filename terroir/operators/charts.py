"""Operators on daily snapshots: latest days, streams per artist, reach, top-N, differences of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import streams

KEY = ["country_code", "snapshot_date"]


def latest_days(facts: DataFrame) -> DataFrame:
    """(country_code, snapshot_date): the latest day of each country."""
    return facts.groupBy("country_code").agg(F.max("snapshot_date").alias("snapshot_date"))


def latest(facts: DataFrame, country: str | None = None) -> DataFrame:
    """The rows of each country's latest day; of one country's only, if given.

    For one country the day is a scalar subquery, which prunes partitions. For all countries the days are an
    aggregate of a few rows for each country, small enough for the optimiser to broadcast.
    """
    if country is not None:
        mine = facts.where(F.col("country_code") == country)
        day = mine.agg(F.max("snapshot_date").alias("d"))
        return mine.where(F.col("snapshot_date") == day.scalar())
    return facts.join(latest_days(facts), KEY)


def recency(facts: DataFrame) -> DataFrame:
    """(country_code, snapshot_date, recency) of the distinct days, 1 for the latest."""
    order = Window.partitionBy("country_code").orderBy(F.desc("snapshot_date"))
    return facts.select(*KEY).distinct().withColumn("recency", F.dense_rank().over(order).cast("bigint"))


def recent(facts: DataFrame, days: int = 2) -> DataFrame:
    """The rows of each country's latest ``days`` days, with their recency."""
    return facts.join(recency(facts).where(F.col("recency") <= days), KEY)


def artist_streams(charts: DataFrame) -> DataFrame:
    """Streams and best position per country and artist on the latest day."""
    return latest(charts).groupBy("country_code", "artist_name").agg(F.sum(streams()).alias("streams"), F.min("position").alias("best_position"))


def top(rows: DataFrame, by: list[str], order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group, with their rank. The filter on the rank limits groups before the shuffle."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("rank") <= limit).withColumn("rank", F.col("rank").cast("bigint"))


def reach(per_country: DataFrame) -> DataFrame:
    """In how many countries each artist is; the input has one row per country and artist."""
    return per_country.groupBy("artist_name").agg(F.count("*").alias("country_count"))


def dedupe_last(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """One whole row per key, the one with the greatest ``order``."""
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def dedupe_first(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """One whole row per key, the one with the least ``order``."""
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def pending(wanted: DataFrame, resolved: DataFrame, key: str) -> DataFrame:
    """Wanted rows whose key isn't resolved yet."""
    return wanted.join(resolved.select(key), key, "left_anti")


def artist_names(*facts: DataFrame) -> DataFrame:
    """Distinct artist names of several fact tables: the seed of the artist dimension."""
    out = facts[0].select("artist_name")
    for more in facts[1:]:
        out = out.unionByName(more.select("artist_name"))
    return out.distinct()
