"""Readers of seeds, raw documents, published records and captured answers. Schemas are fixed, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import blank_to_null, label_artist, label_track, number, stripped


def seed_countries(spark: SparkSession, path: str, schema: str = "listener_name STRING, chart_code STRING, country_name STRING") -> DataFrame:
    """The seed CSV with a header line."""
    return spark.read.csv(path, header=True, schema=schema)


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(priority, term): trimmed non-empty lines of a short list, in order; no rows for a missing file."""
    if not exists(spark, path):
        return spark.createDataFrame([], "priority int, term string")
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("priority", "line"))
    return lines.select("priority", stripped(F.col("line")).alias("term")).where("term <> ''")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at ``path``, by the file system that owns it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON records, or no rows where nothing has been written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def _code() -> Column:
    """The country code that a file is named after."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)\.", 1)


def chart_documents(spark: SparkSession, path: str) -> DataFrame:
    """(country_code, rows) of raw chart documents, one file per country."""
    return spark.read.schema(schemas.RAW_CHART).json(path, multiLine=True).select(_code().alias("country_code"), "rows")


def typed_chart(rows: DataFrame, most: int = 100) -> DataFrame:
    """Chart entries from (country_code, rows array<array<string>>): the first ``most`` rows, short and unreadable ones left out."""
    cells = rows.select("country_code", F.posexplode("rows").alias("line", "cells")).where((F.col("line") < most) & (F.size("cells") > 2))
    cell = lambda i: F.try_element_at("cells", F.lit(i + 1))
    names = {3: "days_on_chart", 4: "peak_position", 6: "daily_streams", 8: "weekly_streams", 10: "total_streams"}
    out = cells.select(
        "country_code",
        number(cell(0)).alias("position"),
        label_artist(cell(2)).alias("artist_name"),
        label_track(cell(2)).alias("track_name"),
        *[number(cell(i)).alias(name) for i, name in names.items()],
    )
    return out.where("position is not null and artist_name is not null")


def listener_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_LISTENERS).json(path, multiLine=True).select(_code().alias("country_code"), "artists", "tags_by_artist")


def listener_rows(documents: DataFrame, most: int = 100) -> DataFrame:
    """(country_code, artist_name, listeners, mbid, pos)"""
    each = documents.select("country_code", F.posexplode("artists").alias("pos", "a")).where(F.col("pos") < most)
    return each.select("country_code", F.col("a.name").alias("artist_name"), F.col("a.listeners").try_cast("bigint").alias("listeners"), blank_to_null(F.col("a.mbid")).alias("mbid"), "pos").where("artist_name is not null")


def ids_in_file_order(spark: SparkSession, path: str) -> DataFrame:
    """(artist_name, mbid, place) of all listener documents under ``path``; ``place`` orders files by name, then rows by their place in the file."""
    documents = spark.read.schema(schemas.RAW_LISTENERS).json(path, multiLine=True).select(F.col("_metadata.file_name").alias("file"), "artists")
    each = documents.select("file", F.posexplode("artists").alias("pos", "a"))
    return each.select(F.col("a.name").alias("artist_name"), blank_to_null(F.col("a.mbid")).alias("mbid"), F.struct("file", "pos").alias("place")).where("artist_name <> ''")


def tag_rows(documents: DataFrame, source: str) -> DataFrame:
    """(country_code, artist_name, pos, tag, count, source) from a map of tag lists."""
    each = documents.select("country_code", F.explode("tags_by_artist").alias("artist_name", "tags")).select("country_code", "artist_name", F.posexplode("tags").alias("pos", "t"))
    return each.select("country_code", "artist_name", "pos", F.col("t.name").alias("tag"), F.col("t.count").alias("count"), F.lit(source).alias("source"))


def genre_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_GENRES).json(path, multiLine=True).select(_code().alias("country_code"), "genres_by_artist")


def genre_rows(documents: DataFrame, source: str) -> DataFrame:
    """Like ``tag_rows`` from a map of plain name lists, whose tags have no count."""
    each = documents.select("country_code", F.explode("genres_by_artist").alias("artist_name", "genres")).select("country_code", "artist_name", F.posexplode("genres").alias("pos", "tag"))
    return each.select("country_code", "artist_name", "pos", "tag", F.lit(None).cast("string").alias("count"), F.lit(source).alias("source"))


def attributes(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(artist_name, attributes) from a JSON map keyed by name; ``value`` is the attributes' DDL."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"MAP<STRING, {value}>")).alias("artist_name", "attributes"))


def table_cells(html: Column) -> Column:
    """array<array<string>>: the rows of a page's first table, without the first one and without rows that have no cell."""
    first = F.regexp_extract(html, r"(?is)<table\b[^>]*>(.*?)</table>", 1)
    rows = F.regexp_extract_all(first, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=</tr>|<tr\b|$)"), 1)
    body = F.when(F.size(rows) > 1, F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    text = lambda x: stripped(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "(?s)<[^>]*>", ""), "&amp;", "&"), "&nbsp;", " "))
    cells = F.transform(body, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)(?=</td>|<td\b|$)"), 1), text))
    return F.filter(F.coalesce(cells, F.array().cast("array<array<string>>")), lambda r: F.size(r) > 0)


def chart_pages(pages: DataFrame, most: int = 100) -> DataFrame:
    """Typed chart entries from captured pages (country_code, html)."""
    return typed_chart(pages.select("country_code", table_cells(F.col("html")).alias("rows")), most)


def captured(raw: DataFrame, schema: str) -> DataFrame:
    """A captured answer (column ``raw``, JSON text) with only the fields of ``schema``."""
    return raw.withColumn("parsed", F.from_json("raw", schema))


def top_artists(raw: DataFrame) -> DataFrame:
    each = captured(raw, schemas.CAPTURED_ARTISTS).select(F.posexplode("parsed.topartists.artist").alias("pos", "a"))
    return each.select("pos", F.col("a.name").alias("artist_name"), F.col("a.listeners").try_cast("bigint").alias("listeners"), blank_to_null(F.col("a.mbid")).alias("mbid"))


def top_tags(raw: DataFrame) -> DataFrame:
    each = captured(raw, schemas.CAPTURED_TAGS).select(F.posexplode("parsed.toptags.tag").alias("pos", "t"))
    return each.select("pos", F.col("t.name").alias("tag"), F.col("t.count").alias("count"))
