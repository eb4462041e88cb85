"""The batch pipeline: cleanse raw documents, load a day, enrich the dimensions, publish."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import headline_artist, summary
from ..functions.vocabulary import OTHER
from ..operators import charts as C
from ..operators import genres as G
from ..params import DEFAULTS, Params
from ..schemas import TABLES
from ..sources import raw, sinks
from . import market


@dataclass(frozen=True)
class Cleansed:
    """What cleansing gives, every frame for all countries: scores with sources, artists behind each genre, artists, tag coverage."""

    scores: DataFrame
    artists: DataFrame
    artist_genres: DataFrame
    coverage: DataFrame
    quality: DataFrame


def top_artists(listeners: DataFrame, charts: DataFrame, most: int = DEFAULTS.rows_per_country) -> DataFrame:
    """(country_code, artist_name, rank): the listener source's artists, and for a country without any those of its chart.

    The first appearance of a name counts; ranks have no gaps. ``listeners`` has pos, ``charts`` position.
    """
    first = listeners.groupBy("country_code", "artist_name").agg(F.min("pos").alias("pos"))
    labels = charts.select("country_code", headline_artist(F.col("artist_name")).alias("artist_name"), (F.col("position") - 1).alias("pos")).where("artist_name is not null")
    fallback = labels.groupBy("country_code", "artist_name").agg(F.min("pos").alias("pos")).join(first.select("country_code").distinct(), "country_code", "left_anti")
    return C.top(first.unionByName(fallback), ["country_code"], [F.asc("pos"), F.asc("artist_name")], most).select("country_code", "artist_name", F.col("rank").cast("bigint").alias("rank"))


def cleanse(artists: DataFrame, tags: DataFrame, countries: DataFrame, canonical: DataFrame | None = None, buckets: DataFrame | None = None, keywords: DataFrame | None = None, fuzzy: bool = True, params: Params = DEFAULTS, within: str | None = None, values: DataFrame | None = None) -> Cleansed:
    """Two passes over all countries: each country's own distribution, then scores against all of them.

    ``artists`` is ``top_artists``; ``tags`` has (country_code, artist_name, pos, tag, count, source), of both sources.
    What all results are made of is worked out once if a folder ``within`` is given to write it to. A table ``values`` (tag)
    that has all tags saves ranking and filtering the rows a second time to look for them.
    """
    once = (lambda df: sinks.kept(df, within)) if within else (lambda df: df)
    artists = once(artists)
    known = G.classified(tags.join(artists.select("country_code", "artist_name"), ["country_code", "artist_name"], "left_semi"), canonical, buckets, keywords, fuzzy, params, values)
    known = once(known)
    scores = once(G.distinctiveness(once(G.vote(known, ["country_code"])), ["country_code"], params))
    links = G.behind(known, ["country_code"])
    rates = G.coverage(known, ["country_code"])
    counts = countries.select(F.col("code").alias("country_code")).join(artists.groupBy("country_code").agg(F.count("*").alias("artist_count")), "country_code", "left").withColumn("artist_count", F.coalesce("artist_count", F.lit(0)))
    return Cleansed(scores, artists, links, rates, G.quality_report(rates, counts, params))


def cleanse_folders(spark: SparkSession, charts: str, listeners: str, genres: str, countries: DataFrame, canonical: DataFrame | None = None, buckets: DataFrame | None = None, keywords: DataFrame | None = None, fuzzy: bool = True, params: Params = DEFAULTS, within: str | None = None) -> Cleansed:
    """Cleanse folders of raw documents, one JSON file for each country: chart lines, listeners with tags, and the genre lists of the second source."""
    heard = raw.listener_documents(spark, listeners)
    artists = top_artists(raw.listener_rows(heard, params.rows_per_country), raw.typed_chart(raw.chart_documents(spark, charts), params.rows_per_country), params.rows_per_country)
    tags = raw.tag_rows(heard, "a").unionByName(raw.genre_rows(raw.genre_documents(spark, genres), "b"))
    return cleanse(artists, tags, countries, canonical, buckets, keywords, fuzzy, params, within)


def genre_worklist(scores: DataFrame, described: DataFrame) -> DataFrame:
    """Genres that still need a description; other isn't described."""
    return C.pending(scores.select("genre").distinct().where(F.col("genre") != OTHER), described, "genre")


def matched(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """One row: how many distinct keys are wanted, and how many of them are known."""
    marked = wanted.select(key).distinct().join(known.select(key).distinct().withColumn("known", F.lit(True)), key, "left")
    return marked.agg(F.count("*").alias("wanted"), F.count("known").alias("matched"))


def latest_records(history: DataFrame) -> DataFrame:
    """Of a record history (country_code, snapshot_date, ...) each country's latest record."""
    return C.dedupe_last(history, ["country_code"], "snapshot_date")


def records(c: Cleansed) -> DataFrame:
    """One nested record per country: artist count, artists, genres with both scores, artists per genre."""
    artists = market._names(c.artists, "rank", "artist_name", "artists").withColumn("artist_count", F.size("artists"))
    genres = c.scores.groupBy("country_code").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("o"), "genre", "score", "distinctiveness", "sources"))), lambda x: F.struct(x["genre"], x["score"], x["distinctiveness"], x["sources"])).alias("genres"))
    behind = c.artist_genres.groupBy("country_code", "genre").agg(F.array_sort(F.collect_list("artist_name")).alias("names"))
    mapped = behind.groupBy("country_code").agg(F.map_from_entries(F.collect_list(F.struct("genre", "names"))).alias("artists_by_genre"))
    return artists.join(genres, "country_code", "left").join(mapped, "country_code", "left")


def store(c: Cleansed, path: str, day: str, stamp) -> None:
    """One day's records with the quality report about them, swapped in together. ``stamp`` is when the report was made."""
    report = c.quality.withColumn("generated_at", F.lit(stamp).cast("timestamp"))
    sinks.store_day({"records": records(c), "coverage": c.coverage, "quality": report}, path, day)


#: Fields of the stored quality report and of the coverage of each country.
REPORT = "countries bigint, average_rate double, empty_countries array<string>, poorly_classified array<string>, generated_at timestamp"
COVERAGE = "country_code string, total_tags bigint, unclassified_tags bigint, unclassified_rate double"


def load_snapshot(spark: SparkSession, root: str, day: str, c: Cleansed, countries: DataFrame, charts: DataFrame, listeners: DataFrame, fans: DataFrame) -> sinks.Counters:
    """Load one day under ``root``: facts are replaced for that day, dimensions are merged by the columns they own.

    Running it again changes nothing. Gives the counters of what was written, by table; see ``run_summary``.
    ``fans`` has (artist_name, fans).
    """
    counters = sinks.Counters()
    facts = {
        "country_snapshots": c.artists.groupBy("country_code").agg(F.count("*").alias("artist_count")),
        "country_genre_scores": c.scores,
        "country_top_artists": c.artists,
        "country_artist_genres": c.artist_genres,
        "country_artist_listeners": C.dedupe_last(listeners, ["country_code", "artist_name"], "pos").select("country_code", "artist_name", "listeners"),
        "chart_entries": C.dedupe_last(charts.withColumn("line", F.struct(*[c for c in charts.columns])), ["country_code", "position"], "line").drop("line"),
    }
    for table, rows in facts.items():
        sinks.replace_day(rows, f"{root}/{table}", table, day, counters)
    sinks.merge_dimension(countries.select("code", "name"), f"{root}/countries", "countries", ["name"], counters)
    loaded = {t: sinks.read_table(spark, f"{root}/{t}", t).where(F.col("snapshot_date") == F.lit(day).cast("date")) for t in facts}
    names = C.artist_names(loaded["chart_entries"], loaded["country_artist_listeners"])
    sinks.merge_dimension(names, f"{root}/artists", "artists")
    sinks.merge_dimension(C.dedupe_last(fans.where("artist_name is not null"), ["artist_name"], "fans").join(names, "artist_name", "left_semi"), f"{root}/artists", "artists", ["fans"], counters)
    sinks.merge_dimension(loaded["country_genre_scores"].select("genre").distinct(), f"{root}/genres", "genres", counters=counters)
    return counters


def run_summary(counters: sinks.Counters) -> dict[str, float]:
    """The figures of a load: countries loaded and skipped, rows of each table, artists with fans and their share."""
    found = counters.found
    loaded, artists, known = found["country_snapshots"]["rows"], found["artists"]["rows"], found["artists"]["fans"]
    return {name: count["rows"] for name, count in found.items()} | {
        "countries_loaded": loaded,
        "countries_skipped": found["countries"]["rows"] - loaded,
        "artists_with_fans": known,
        "share_with_fans": round(known / artists, 4) if artists else 0.0,
    }


def warehouse(spark: SparkSession, root: str) -> market.Warehouse:
    """The tables under ``root``."""
    names = ["chart_entries", "artists", "country_artist_listeners", "country_genre_scores", "country_artist_genres", "countries", "country_snapshots", "country_top_artists", "genres"]
    return market.Warehouse(**{n: sinks.read_table(spark, f"{root}/{n}", n) for n in names})


def store_resolved(resolved: DataFrame, root: str, stamp) -> None:
    """Enter resolved artists; those whose look-up failed stay pending."""
    done = resolved.where("status <> 'error'").select("artist_name", "mbid", "origin_country", "formed_year").withColumn("resolved_at", F.lit(stamp).cast("timestamp"))
    sinks.merge_dimension(done, f"{root}/artists", "artists", ["mbid", "origin_country", "formed_year", "resolved_at"])


def described_genres(captured: DataFrame, stamp) -> DataFrame:
    """(genre, summary, url, resolved_at) from captured (genre, html, url); genres without a description are stamped too, other isn't described."""
    return captured.where("genre <> 'other'").select("genre", summary(F.col("html")).alias("summary"), "url", F.lit(stamp).cast("timestamp").alias("resolved_at"))


def images_needed(artists: DataFrame, mbids: DataFrame, pictures: DataFrame, looked_up: DataFrame) -> DataFrame:
    """(artist_name, mbid) of artists that have an id but no usable picture and weren't looked up before."""
    open_ = C.pending(C.pending(artists.select("artist_name").distinct(), pictures, "artist_name"), looked_up, "artist_name")
    return open_.join(mbids.where("mbid is not null"), "artist_name")


def publish(w: market.Warehouse, out: str, images: DataFrame | None = None) -> None:
    """The four payload families as JSON: summaries, one folder per country, worldwide ranking, trending genres."""
    sinks.publish_json(market.country_summaries(w, images), f"{out}/summaries")
    sinks.publish_json(market.country_detail(w, images).withColumn("code", F.lower("country_code")), f"{out}/countries", by="code")
    sinks.publish_json(market.global_artists(w), f"{out}/global_artists")
    sinks.publish_json(market.trending_genres(w), f"{out}/trending_genres")


_SHARE = "array<struct<genre: string, percentage: double, score: bigint, distinctiveness: double, sources: array<string>>>"
_SUMMARY = "country_code string, name string, artist_count bigint, top_genres array<string>, distinctive_genres array<string>, top_artists array<string>, domestic_share struct<domestic_percentage: double, coverage_percentage: double>, cover_image string"

#: Fields of the four payload families.
PAYLOADS = {
    "summaries": _SUMMARY,
    "countries": f"""{_SUMMARY}, code string,
        chart array<struct<position: bigint, artist: string, track: string, streams: bigint>>,
        popularity array<struct<artist: string, streams: bigint, listeners: bigint, fans: bigint>>,
        genres {_SHARE}, other_percentage double, other_genres bigint, special_genres {_SHARE},
        hidden_gems array<struct<artist: string, streams: bigint, best_position: bigint, country_count: bigint, gem_score: double>>,
        genre_details map<string, struct<summary: string, url: string, artists: array<struct<artist: string, streams: bigint, best_position: bigint>>>>""",
    "global_artists": "artist_name string, streams bigint, previous_streams bigint, country_count bigint, delta bigint, origin_country string",
    "trending_genres": "country_code string, genre string, score bigint, previous_score bigint, delta bigint",
}


def published(spark: SparkSession, out: str, family: str) -> DataFrame:
    """One family of payloads read back; no rows where nothing was published yet."""
    return raw.read_or_empty(spark, f"{out}/{family}", PAYLOADS[family])


__all__ = ["TABLES", "Cleansed", "cleanse", "cleanse_folders", "described_genres", "genre_worklist", "images_needed", "latest_records", "load_snapshot", "matched", "publish", "published", "records", "run_summary", "store", "store_resolved", "top_artists", "warehouse"]
