"""The analytics that users call. Every function takes tables and covers all countries in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import remainder, streams
from ..operators import charts as C
from ..operators import compare
from ..operators.matching import covers

#: What genre shares may be weighted by.
WEIGHTS = {"popularity": "score", "distinctiveness": "distinctiveness"}


@dataclass(frozen=True)
class Warehouse:
    """The tables that the analytics read."""

    chart_entries: DataFrame
    artists: DataFrame
    country_artist_listeners: DataFrame
    country_genre_scores: DataFrame
    country_artist_genres: DataFrame
    countries: DataFrame | None = None
    country_snapshots: DataFrame | None = None
    country_top_artists: DataFrame | None = None
    genres: DataFrame | None = None


def hidden_gems(w: Warehouse, limit: int = 10) -> DataFrame:
    """Per country the artists whose streams weigh most against the number of countries they chart in."""
    current = C.artist_streams(w.chart_entries).withColumn("country_count", F.count("*").over(Window.partitionBy("artist_name")))
    # every country of the chart has a latest day, so its names are all that has to be read for their number
    scope = w.chart_entries.agg(F.count_distinct("country_code").alias("total_countries"))
    met = current.crossJoin(F.broadcast(scope)).where("country_count < total_countries")
    scored = met.withColumn("gem_score", F.round(F.col("streams") * F.ln(F.col("total_countries") / F.col("country_count")), 1))
    return C.top(scored, ["country_code"], [F.desc("gem_score"), F.asc("artist_name")], limit)


def artist_popularity(w: Warehouse, limit: int = 12) -> DataFrame:
    """Per country streams, listeners and fans of an artist side by side; those measured by both sources first."""
    played = C.artist_streams(w.chart_entries).select("country_code", "artist_name", "streams")
    heard = C.latest(w.country_artist_listeners).select("country_code", "artist_name", "listeners")
    met = played.join(heard, ["country_code", "artist_name"], "full_outer").join(w.artists.select("artist_name", "fans"), "artist_name", "left")
    both = F.col("streams").isNotNull() & F.col("listeners").isNotNull()
    return C.top(met, ["country_code"], [both.desc(), F.desc_nulls_last("streams"), F.desc_nulls_last("listeners"), F.asc("artist_name")], limit)


def weighted_genres(w: Warehouse, mode: str = "popularity") -> DataFrame:
    """Per country all qualifying genres with their share, unranked."""
    if mode not in WEIGHTS:
        raise ValueError(f"unknown mode {mode}; known: {', '.join(WEIGHTS)}")
    weight = F.col(WEIGHTS[mode])
    mine = Window.partitionBy("country_code")
    latest = C.latest(w.country_genre_scores).where(weight > 0)
    whole = latest.withColumns({"total_weight": F.sum(weight).over(mine), "genre_count": F.count("*").over(mine)})
    return whole.withColumn("percentage", F.round(100.0 * weight / F.nullif("total_weight", F.lit(0)), 2))


def genre_shares(w: Warehouse, mode: str = "popularity", limit: int = 15) -> DataFrame:
    """Per country the leading genres with their share of all qualifying ones, not only of those shown."""
    return C.top(weighted_genres(w, mode), ["country_code"], [F.desc(WEIGHTS[mode]), F.asc("genre")], limit)


def genre_breakdown(shown: DataFrame) -> DataFrame:
    """Per country what the shown genres leave: the rest of 100 percent and the number of genres not shown."""
    return shown.groupBy("country_code").agg(remainder(F.round(F.sum("percentage"), 6)).alias("other_percentage"), (F.max("genre_count") - F.count("*")).alias("other_genres"))


def domestic_share(w: Warehouse, country: str | None = None) -> DataFrame:
    """Streams by domestic artists among those of known origin, and how much of the chart that covers."""
    entries = C.latest(w.chart_entries, country).select("country_code", "artist_name", streams().alias("streams"))
    placed = entries.join(w.artists.select("artist_name", "origin_country"), "artist_name", "left")
    known = F.col("origin_country").isNotNull()
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("streams"))), F.lit(0))
    sums = placed.groupBy("country_code").agg(
        F.coalesce(F.sum("streams"), F.lit(0)).alias("total_streams"),
        total(known).alias("classified_streams"),
        total(F.col("origin_country") == F.col("country_code")).alias("domestic_streams"),
        F.count("*").alias("entry_count"),
        F.count_if(known).alias("classified_entries"),
    )
    percent = lambda a, b: F.round(F.try_divide(100.0 * F.col(a), F.col(b)), 2)
    return sums.withColumns({"domestic_percentage": percent("domestic_streams", "classified_streams"), "coverage_percentage": percent("classified_streams", "total_streams")})


def genre_artists(w: Warehouse, genres: list[str] | DataFrame | None = None, limit: int = 5) -> DataFrame:
    """Per country and genre the example artists, by streams; those who don't chart come last.

    ``genres`` is a short list, or a table (country_code, genre) of the wanted panels.
    """
    linked = C.latest(w.country_artist_genres).select("country_code", "genre", "artist_name")
    if isinstance(genres, DataFrame):
        linked = linked.join(genres.select("country_code", "genre"), ["country_code", "genre"], "left_semi")
    elif genres is not None:
        linked = linked.where(F.col("genre").isin(genres))
    met = linked.join(C.artist_streams(w.chart_entries), ["country_code", "artist_name"], "left")
    return C.top(met, ["country_code", "genre"], [F.desc_nulls_last("streams"), F.asc("artist_name")], limit)


def global_artists(w: Warehouse, limit: int | None = 40) -> DataFrame:
    """The worldwide ranking: streams, reach and the change since each country's snapshot before."""
    per_country = C.recent(w.chart_entries).groupBy("artist_name", "country_code", "recency").agg(F.sum(streams()).alias("streams"))
    now, before = F.col("recency") == 1, F.col("recency") == 2
    totals = per_country.groupBy("artist_name").agg(F.sum(F.when(now, F.col("streams"))).alias("streams"), F.sum(F.when(before, F.col("streams"))).alias("previous_streams"), F.count_if(now).alias("country_count"))
    out = totals.where("streams is not null").withColumn("delta", F.col("streams") - F.col("previous_streams")).join(w.artists.select("artist_name", "origin_country"), "artist_name", "left")
    return out.orderBy(F.desc("streams"), "artist_name").limit(limit) if limit else out


def similar_countries(w: Warehouse, limit: int | None = 20, min_share: float = 0.0) -> DataFrame:
    """Pairs of countries by the number of genres in common, with the genres."""
    latest = C.latest(w.country_genre_scores)
    if min_share:
        total = F.sum("score").over(Window.partitionBy("country_code"))
        latest = latest.withColumn("total", total).where(F.col("score") >= min_share * F.col("total"))
    a = latest.select("genre", F.col("country_code").alias("country_a"))
    b = latest.select("genre", F.col("country_code").alias("country_b"))
    pairs = a.join(b, "genre").where("country_a < country_b").groupBy("country_a", "country_b")
    out = pairs.agg(F.count("*").alias("shared_genres"), F.array_sort(F.collect_list("genre")).alias("genres_in_common"))
    return out.orderBy(F.desc("shared_genres"), "country_a", "country_b").limit(limit) if limit else out


def genre_changes(w: Warehouse) -> DataFrame:
    """Per country and genre the score, the score of the snapshot before and their difference."""
    recent = C.recent(w.country_genre_scores)
    before = F.lag("score").over(Window.partitionBy("country_code", "genre").orderBy("snapshot_date"))
    changed = recent.select("country_code", "genre", "score", before.alias("previous_score")).where("previous_score is not null")
    return changed.withColumn("delta", F.col("score") - F.col("previous_score"))


def trending_genres(w: Warehouse, limit: int = 50) -> DataFrame:
    """The largest rises."""
    return genre_changes(w).orderBy(F.desc("delta"), "country_code", "genre").limit(limit)


def trending_tails(w: Warehouse, limit: int = 25) -> DataFrame:
    """The largest rises and the largest falls, so that neither hides the other."""
    changed = genre_changes(w)
    up = changed.where("delta > 0").orderBy(F.desc("delta"), "country_code", "genre").limit(limit).withColumn("tail", F.lit("rising"))
    down = changed.where("delta < 0").orderBy("delta", "country_code", "genre").limit(limit).withColumn("tail", F.lit("falling"))
    return up.unionByName(down)


def chart_head(w: Warehouse, limit: int = 10) -> DataFrame:
    """Per country the first positions of the latest day."""
    return C.top(C.latest(w.chart_entries), ["country_code"], [F.asc("position")], limit)


def _nested(rows: DataFrame, by: list[str], order: str, fields: list[str | Column], name: str) -> DataFrame:
    """``rows`` as one sorted array of structs per group."""
    made = F.array_sort(F.collect_list(F.struct(order, F.struct(*fields).alias("v"))))
    return rows.groupBy(*by).agg(F.transform(made, lambda x: x["v"]).alias(name))


def _names(rows: DataFrame, order: str, value: str, name: str) -> DataFrame:
    return rows.groupBy("country_code").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias(name))


def country_summaries(w: Warehouse, images: DataFrame | None = None, artists: int = 5, genres: int = 3) -> DataFrame:
    """The headline row of every country: counts, top and distinctive genres, top artists, domestic share, cover."""
    by = Window.partitionBy("country_code")
    ranked = C.latest(w.country_genre_scores).select(
        "country_code",
        "genre",
        "distinctiveness",
        F.row_number().over(by.orderBy(F.desc("score"), "genre")).alias("popular"),
        F.row_number().over(by.orderBy(F.desc("distinctiveness"), "genre")).alias("special"),
    )
    counts = w.country_snapshots.groupBy("country_code").agg(F.max_by("artist_count", "snapshot_date").alias("artist_count"))
    leading = C.latest(w.country_top_artists).where(F.col("rank") <= artists)
    domestic = domestic_share(w).select("country_code", F.struct("domestic_percentage", "coverage_percentage").alias("domestic_share"))
    out = w.countries.select(F.col("code").alias("country_code"), "name").join(counts, "country_code", "left")
    for part in (_names(ranked.where(F.col("popular") <= genres), "popular", "genre", "top_genres"), _names(ranked.where((F.col("special") <= genres) & (F.col("distinctiveness") > 0)), "special", "genre", "distinctive_genres"), _names(leading, "rank", "artist_name", "top_artists"), domestic):
        out = out.join(part, "country_code", "left")
    out = out.join(covers(leading, images), "country_code", "left") if images is not None else out.withColumn("cover_image", F.lit(None).cast("string"))
    empty = F.array().cast("array<string>")
    return out.select("country_code", "name", F.coalesce("artist_count", F.lit(0)).alias("artist_count"), *[F.coalesce(c, empty).alias(c) for c in ("top_genres", "distinctive_genres", "top_artists")], "domestic_share", "cover_image")


def country_detail(w: Warehouse, images: DataFrame | None = None) -> DataFrame:
    """Everything about a country in one nested row, for all countries at once."""
    popular, special = genre_shares(w, "popularity"), genre_shares(w, "distinctiveness")
    wanted = popular.select("country_code", "genre").union(special.select("country_code", "genre")).distinct()
    panels = _nested(genre_artists(w, wanted), ["country_code", "genre"], "rank", [F.col("artist_name").alias("artist"), "streams", "best_position"], "artists")
    if w.genres is not None:
        panels = panels.join(w.genres.select("genre", "summary", "url"), "genre", "left")
    else:
        panels = panels.withColumns({"summary": F.lit(None).cast("string"), "url": F.lit(None).cast("string")})
    details = panels.groupBy("country_code").agg(F.map_from_entries(F.collect_list(F.struct("genre", F.struct("summary", "url", "artists")))).alias("genre_details"))
    share = ["genre", "percentage", "score", "distinctiveness", "sources"]
    parts = [
        _nested(chart_head(w), ["country_code"], "rank", ["position", F.col("artist_name").alias("artist"), F.col("track_name").alias("track"), streams().alias("streams")], "chart"),
        _nested(artist_popularity(w), ["country_code"], "rank", [F.col("artist_name").alias("artist"), "streams", "listeners", "fans"], "popularity"),
        _nested(popular, ["country_code"], "rank", share, "genres").join(genre_breakdown(popular), "country_code"),
        _nested(special, ["country_code"], "rank", share, "special_genres"),
        _nested(hidden_gems(w), ["country_code"], "rank", [F.col("artist_name").alias("artist"), "streams", "best_position", "country_count", "gem_score"], "hidden_gems"),
        details,
    ]
    out = country_summaries(w, images)
    for part in parts:
        out = out.join(part, "country_code", "left")
    return out


#: What ``flattened`` makes of each list of a country: its column, and the field that goes to ``name``, to ``detail``, and to the numbers.
_LISTS = {
    "popularity": ("artist", None, ["streams", "listeners", "fans"]),
    "genres": ("genre", "sources", ["percentage", "score", "distinctiveness"]),
    "special_genres": ("genre", "sources", ["percentage", "score", "distinctiveness"]),
    "hidden_gems": ("artist", None, ["streams", "best_position", "country_count", "gem_score"]),
    "chart": ("artist", "track", ["position", "streams"]),
}


def flattened(details: DataFrame) -> DataFrame:
    """``country_detail`` as plain rows (country_code, part, place, name, detail, v1 to v4), so that it can be compared or loaded elsewhere.

    Lists keep their order in ``place``, from 1; a genre's panel is a part of its own with its artists, and one row of
    place 0 for its description; what the shown genres leave is the part ``rest``.
    """
    number = lambda c: F.col(c).cast("double")
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def rows(df: DataFrame, part, place, name, detail, values: list) -> DataFrame:
        padded = [*values, *[none] * (4 - len(values))]
        return df.select("country_code", part.alias("part"), place.cast("long").alias("place"), name.alias("name"), detail.alias("detail"), *[v.alias(f"v{i}") for i, v in enumerate(padded, 1)])

    out = rows(details, F.lit("rest"), F.lit(0), text, text, [number("other_percentage"), number("other_genres")])
    for column, (name, detail, values) in _LISTS.items():
        each = details.select("country_code", F.posexplode(column).alias("pos", "v"))
        told = F.array_join("v.sources", ",") if detail == "sources" else F.col(f"v.{detail}") if detail else text
        out = out.unionByName(rows(each, F.lit(column), F.col("pos") + 1, F.col(f"v.{name}"), told, [number(f"v.{c}") for c in values]))
    panels = details.select("country_code", F.explode("genre_details").alias("genre", "panel"))
    part = F.concat(F.lit("panel:"), F.col("genre"))
    out = out.unionByName(rows(panels, part, F.lit(0), F.col("panel.summary"), F.col("panel.url"), []))
    artists = panels.select("country_code", "genre", F.posexplode("panel.artists").alias("pos", "v"))
    return out.unionByName(rows(artists, part, F.col("pos") + 1, F.col("v.artist"), text, [number("v.streams"), number("v.best_position")]))


def genre_panel(details: DataFrame, code: str, genre: str) -> DataFrame:
    """One country's panel of a genre out of ``country_detail``: null if it has none; the code's case doesn't matter."""
    mine = details.where(F.lower("country_code") == code.lower())
    return mine.select("country_code", F.try_element_at("genre_details", F.lit(genre)).alias("panel"))


def percentages(w: Warehouse) -> DataFrame:
    """(country_code, genre, percentage) over all genres of the latest day."""
    return weighted_genres(w).select("country_code", "genre", "percentage")


def compare_all(w: Warehouse) -> DataFrame:
    return compare.overlap_all(percentages(w))


def compare_two(w: Warehouse, left: str, right: str, limit: int = 10) -> DataFrame:
    return compare.differences(percentages(w), left, right, limit)


def choropleth(w: Warehouse, mode: str, min_coverage: float = 20.0) -> DataFrame:
    """(country_code, class): the leading genre's class, or the band of the domestic share."""
    if mode == "genre":
        leaders = C.top(C.latest(w.country_genre_scores), ["country_code"], [F.desc("score"), F.asc("genre")], 1)
        return compare.leader_classes(leaders.select("country_code", "genre"))
    if mode == "domestic":
        return compare.domestic_classes(domestic_share(w), min_coverage)
    raise ValueError(f"unknown mode {mode}")


def pending_artists(w: Warehouse, budget: int = 250) -> DataFrame:
    """Artists never looked up, the most charted first."""
    charted = w.chart_entries.groupBy("artist_name").agg(F.count("*").alias("chart_rows"))
    open_ = w.artists.where("resolved_at is null").select("artist_name")
    return open_.join(charted, "artist_name", "left").withColumn("chart_rows", F.coalesce("chart_rows", F.lit(0))).orderBy(F.desc("chart_rows"), "artist_name").limit(budget)
