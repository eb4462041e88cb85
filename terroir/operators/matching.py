"""Entity resolution: best candidates, first and single answers, sources with precedence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import name_key
from ..functions.text import picture, thumbnail, year


def best_candidates(candidates: DataFrame) -> DataFrame:
    """(query, id, name, nb_fan, picture): the candidate with the query's own name key and the most fans, or no row.

    ``candidates`` has (query, pos, id, name, nb_fan, picture_medium, picture_big).
    """
    keyed = candidates.where("query is not null and name is not null")
    same = keyed.where(name_key("query") == name_key("name"))
    best = same.groupBy("query").agg(F.max_by(F.struct("id", "name", "nb_fan", "picture_medium", "picture_big"), F.struct(F.coalesce("nb_fan", F.lit(0)), -F.col("pos"))).alias("b"))
    return best.select("query", "b.id", "b.name", "b.nb_fan", picture(F.col("b.picture_medium"), F.col("b.picture_big")).alias("picture"))


def bindings(captured: DataFrame) -> DataFrame:
    """(pos, mbid, name, item, iso, inception, image) from captured entity answers (column ``results``)."""
    rows = captured.select(F.posexplode("results.bindings").alias("pos", "b"))
    return rows.select("pos", *[F.col(f"b.{c}.value").alias(c) for c in ("mbid", "name", "item", "iso", "inception", "image")])


def entity_meta(rows: DataFrame, key: str) -> DataFrame:
    """(key, origin_country, formed_year): per key the first code and the first year that are there."""
    known = rows.where(F.col(key).isNotNull())
    return known.groupBy(key).agg(
        F.lower(F.min_by("iso", F.when(F.col("iso").isNotNull(), F.col("pos")))).alias("origin_country"),
        F.min_by(year(F.col("inception")), F.when(year(F.col("inception")).isNotNull(), F.col("pos"))).alias("formed_year"),
    )


def entity_meta_by_name(rows: DataFrame) -> DataFrame:
    """Like ``entity_meta`` by name; a name that stands for two entities gives no answer."""
    single = rows.where("name is not null").groupBy("name").agg(F.count_distinct("item").alias("items")).where("items = 1").select("name")
    return entity_meta(rows.join(single, "name"), "name")


def entity_images(rows: DataFrame) -> DataFrame:
    """(mbid, image): the first complete row's picture over https with a width."""
    whole = rows.where("mbid is not null and image is not null")
    return whole.groupBy("mbid").agg(thumbnail(F.min_by("image", "pos")).alias("image"))


def first_mbid(rows: DataFrame, order: str = "pos") -> DataFrame:
    """(artist_name, mbid): every name, with the first non-empty id it came with; a null is upgraded by a later row. ``rows`` has (artist_name, mbid, order)."""
    named = F.nullif("mbid", F.lit(""))
    return rows.groupBy("artist_name").agg(F.min_by(named, F.when(named.isNotNull(), F.col(order))).alias("mbid"))


def resolve(pending: DataFrame, mbids: DataFrame, by_id: DataFrame, by_name: DataFrame, searched: DataFrame) -> DataFrame:
    """(artist_name, mbid, origin_country, formed_year, status) in three passes, each over what the ones before left.

    Exact id first, then unambiguous names, then search answers (artist_name, mbid, origin_country, formed_year, failed).
    ``status`` is hit, miss or error; only errors stay pending. Several names with one id all get its answer.
    """
    wanted = pending.select("artist_name").distinct().join(first_mbid(mbids), "artist_name", "left")
    ids = by_id.select("mbid", F.struct("origin_country", "formed_year").alias("one"))
    names = by_name.select(F.col("name").alias("artist_name"), F.struct("origin_country", "formed_year").alias("two"))
    asked = searched.select("artist_name", F.struct("mbid", "origin_country", "formed_year", "failed").alias("three"))
    met = wanted.join(ids, "mbid", "left").join(names, "artist_name", "left").join(asked, "artist_name", "left")
    got = F.coalesce("one", "two", F.when(~F.coalesce("three.failed", F.lit(False)), F.struct("three.origin_country", "three.formed_year")))
    hit = F.coalesce(got["origin_country"].isNotNull() | got["formed_year"].isNotNull(), F.lit(False))
    status = F.when(hit, "hit").when(F.col("three.failed"), "error").otherwise("miss")
    return met.select("artist_name", F.coalesce("mbid", "three.mbid").alias("mbid"), got["origin_country"].alias("origin_country"), got["formed_year"].alias("formed_year"), status.alias("status"))


def images(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """(artist_name, image): the primary source's picture, else the secondary's."""
    one = primary.select("artist_name", F.col("image").alias("first_image"))
    two = secondary.select("artist_name", F.col("image").alias("second_image"))
    return one.join(two, "artist_name", "full_outer").select("artist_name", F.coalesce("first_image", "second_image").alias("image")).where("image is not null")


def covers(ranked: DataFrame, pictures: DataFrame, key: str = "country_code") -> DataFrame:
    """(key, cover_image): the picture of the best-ranked artist that has one."""
    return ranked.join(pictures, "artist_name").groupBy(key).agg(F.min_by("image", "rank").alias("cover_image"))


def resolved_codes(features: DataFrame, codes: DataFrame) -> DataFrame:
    """(feature_id, code): the first candidate that is a known alpha-2, alpha-3 or number; ``-99`` is no code.

    ``features`` has (feature_id, candidates array<string>), ``codes`` has (alpha2, alpha3, number).
    """
    known = codes.select(F.lower("alpha2").alias("code"), F.explode(F.array(F.lower("alpha2"), F.lower("alpha3"), F.lpad(F.col("number").cast("string"), 3, "0"))).alias("key"))
    tried = features.select("feature_id", F.posexplode("candidates").alias("pos", "raw")).where("raw is not null and raw <> '-99'")
    keyed = tried.withColumn("key", F.when(F.col("raw").rlike(r"^\d{1,3}$"), F.lpad("raw", 3, "0")).otherwise(F.lower("raw")))
    found = keyed.join(known, "key").groupBy("feature_id").agg(F.min_by("code", "pos").alias("code"))
    return features.select("feature_id").join(found, "feature_id", "left")
