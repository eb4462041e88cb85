"""The registered queries on the driver's tables and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import testview
from .functions import text as X
from .functions import vocabulary
from .functions.names import name_key
from .operators import charts as C
from .operators import compare, lookups, matching
from .operators import genres as G
from .plans import market, refresh
from .sources import raw, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, views: bool = True):
    """Register a query under its function's name; ``sql`` gets the test views in front unless ``views`` is off."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = f"WITH {testview.VIEWS}{',' if sql.lstrip().startswith('+') else ''}{sql.lstrip().removeprefix('+')}" if views else sql
        return f

    return register


def _w(spark: SparkSession, sf_dir: str) -> testview.View:
    """The warehouse for figures of the latest days; it needn't hold older ones."""
    return testview.warehouse(spark, sf_dir, recent=True)


def _history(spark: SparkSession, sf_dir: str) -> testview.View:
    return testview.warehouse(spark, sf_dir)


# ---- the warehouse analytics

@query("""
, spread AS (SELECT *, count(*) OVER (PARTITION BY artist_name) AS country_count, (SELECT count(DISTINCT n) FROM (SELECT country_code AS n FROM latest_chart)) AS total_countries FROM current_streams)
SELECT country_code, artist_name, streams, best_position, country_count, total_countries, round(streams * ln(total_countries / country_count), 1) AS gem_score,
       row_number() OVER (PARTITION BY country_code ORDER BY round(streams * ln(total_countries / country_count), 1) DESC, artist_name) AS rank
FROM spread WHERE country_count < total_countries QUALIFY rank <= 10""")
def hidden_gems(spark, sf_dir):
    return market.hidden_gems(_w(spark, sf_dir))


@query("""
SELECT country_code, artist_name, streams, listeners, fans, rank FROM (
  SELECT coalesce(s.country_code, l.country_code) AS country_code, coalesce(s.artist_name, l.artist_name) AS artist_name, streams, listeners, fans,
         row_number() OVER (PARTITION BY coalesce(s.country_code, l.country_code) ORDER BY (streams IS NOT NULL AND listeners IS NOT NULL) DESC, streams DESC NULLS LAST, listeners DESC NULLS LAST, coalesce(s.artist_name, l.artist_name)) AS rank
  FROM current_streams s FULL OUTER JOIN (
    SELECT l.* FROM country_artist_listeners l JOIN (SELECT country_code, max(snapshot_date) AS d FROM country_artist_listeners GROUP BY 1) m ON l.country_code = m.country_code AND l.snapshot_date = m.d) l
    ON s.country_code = l.country_code AND s.artist_name = l.artist_name
  LEFT JOIN artists a ON a.artist_name = coalesce(s.artist_name, l.artist_name)) WHERE rank <= 12""")
def artist_popularity(spark, sf_dir):
    return market.artist_popularity(_w(spark, sf_dir))


SHARES = """+ weighted AS (
  SELECT country_code, snapshot_date, genre, score, distinctiveness, sources, sum({w}) OVER (PARTITION BY country_code) AS total_weight, count(*) OVER (PARTITION BY country_code) AS genre_count,
         row_number() OVER (PARTITION BY country_code ORDER BY {w} DESC, genre) AS rank
  FROM latest_genres WHERE {w} > 0),
top_shares AS (SELECT *, round(100.0::DOUBLE * {w} / nullif(total_weight, 0), 2) AS percentage FROM weighted WHERE rank <= 15)"""


@query(SHARES.format(w="score") + "SELECT country_code, genre, score, array_to_string(sources, ',') AS sources, CAST(total_weight AS BIGINT) AS total_weight, genre_count, percentage, rank FROM top_shares")
def genre_shares(spark, sf_dir):
    return market.genre_shares(_w(spark, sf_dir)).select("country_code", "genre", "score", F.array_join("sources", ",").alias("sources"), "total_weight", "genre_count", "percentage", "rank")


@query(SHARES.format(w="distinctiveness") + "SELECT country_code, genre, distinctiveness, genre_count, rank FROM top_shares")
def genre_shares_distinctive(spark, sf_dir):
    return market.genre_shares(_w(spark, sf_dir), "distinctiveness").select("country_code", "genre", "distinctiveness", "genre_count", "rank")


@query(
    SHARES.format(w="score")
    + "SELECT country_code, greatest(0.0::DOUBLE, round(100 - round(sum(percentage), 6), 2)) AS other_percentage, max(genre_count) - count(*) AS other_genres FROM top_shares GROUP BY 1"
)
def share_with_remainder(spark, sf_dir):
    return market.genre_breakdown(market.genre_shares(_w(spark, sf_dir)))


DOMESTIC = """+ domestic AS (
  SELECT country_code, total_streams, classified_streams, domestic_streams, entry_count, classified_entries, round(100.0::DOUBLE * domestic_streams / nullif(classified_streams, 0), 2) AS domestic_percentage,
         round(100.0::DOUBLE * classified_streams / nullif(total_streams, 0), 2) AS coverage_percentage
  FROM (SELECT c.country_code, CAST(coalesce(sum(s), 0) AS BIGINT) AS total_streams, CAST(coalesce(sum(CASE WHEN origin_country IS NOT NULL THEN s END), 0) AS BIGINT) AS classified_streams,
               CAST(coalesce(sum(CASE WHEN origin_country = c.country_code THEN s END), 0) AS BIGINT) AS domestic_streams, count(*) AS entry_count, count(*) FILTER (origin_country IS NOT NULL) AS classified_entries
        FROM (SELECT e.country_code, artist_name, coalesce(daily_streams, weekly_streams, total_streams, 0) AS s FROM chart_entries e JOIN latest_chart l ON e.country_code = l.country_code AND e.snapshot_date = l.snapshot_date) c
        LEFT JOIN artists a ON c.artist_name = a.artist_name GROUP BY 1))"""


@query(DOMESTIC + "SELECT * FROM domestic WHERE country_code = 'NATION_1'")
def domestic_share(spark, sf_dir):
    return market.domestic_share(_w(spark, sf_dir), "NATION_1")


@query(DOMESTIC + "SELECT * FROM domestic")
def domestic_share_all(spark, sf_dir):
    return market.domestic_share(_w(spark, sf_dir))


@query("""
SELECT country_code, genre, artist_name, streams, best_position, rank FROM (
  SELECT g.country_code, g.genre, g.artist_name, streams, best_position, row_number() OVER (PARTITION BY g.country_code, g.genre ORDER BY streams DESC NULLS LAST, g.artist_name) AS rank
  FROM country_artist_genres g JOIN (SELECT country_code, max(snapshot_date) AS d FROM country_artist_genres GROUP BY 1) m ON g.country_code = m.country_code AND g.snapshot_date = m.d
  LEFT JOIN current_streams s ON g.country_code = s.country_code AND g.artist_name = s.artist_name) WHERE rank <= 5""")
def genre_artists(spark, sf_dir):
    return market.genre_artists(_w(spark, sf_dir))


@query("""
, totals AS (
  SELECT artist_name, CAST(sum(s) FILTER (recency = 1) AS BIGINT) AS streams, CAST(sum(s) FILTER (recency = 2) AS BIGINT) AS previous_streams, count(DISTINCT country_code) FILTER (recency = 1) AS country_count
  FROM (SELECT e.country_code, artist_name, recency, coalesce(daily_streams, weekly_streams, total_streams, 0) AS s FROM chart_entries e JOIN recent_days d ON e.country_code = d.country_code AND e.snapshot_date = d.snapshot_date WHERE recency <= 2)
  GROUP BY 1)
SELECT t.artist_name, streams, previous_streams, streams - previous_streams AS delta, country_count, origin_country FROM totals t LEFT JOIN artists a ON t.artist_name = a.artist_name
WHERE streams IS NOT NULL ORDER BY streams DESC, t.artist_name LIMIT 40""")
def global_artists(spark, sf_dir):
    return market.global_artists(_w(spark, sf_dir))


@query("""
SELECT a.country_code AS country_a, b.country_code AS country_b, count(*) AS shared_genres, string_agg(a.genre, ',' ORDER BY a.genre) AS genres_in_common
FROM latest_genres a JOIN latest_genres b ON a.genre = b.genre AND a.country_code < b.country_code GROUP BY ALL ORDER BY shared_genres DESC, country_a, country_b LIMIT 20""")
def similar_countries(spark, sf_dir):
    return market.similar_countries(_w(spark, sf_dir)).withColumn("genres_in_common", F.array_join("genres_in_common", ","))


CHANGES = """+ genre_days AS (SELECT country_code, snapshot_date, dense_rank() OVER (PARTITION BY country_code ORDER BY snapshot_date DESC) AS recency FROM (SELECT DISTINCT country_code, snapshot_date FROM country_genre_scores)),
changes AS (SELECT *, score - previous_score AS delta FROM (
  SELECT g.country_code, genre, score, lag(score) OVER (PARTITION BY g.country_code, genre ORDER BY g.snapshot_date) AS previous_score
  FROM country_genre_scores g JOIN genre_days d ON g.country_code = d.country_code AND g.snapshot_date = d.snapshot_date WHERE recency <= 2) WHERE previous_score IS NOT NULL)"""


@query(CHANGES + "SELECT * FROM changes ORDER BY delta DESC, country_code, genre LIMIT 50")
def trending_genres(spark, sf_dir):
    return market.trending_genres(_w(spark, sf_dir))


@query(
    CHANGES
    + """ SELECT *, 'rising' AS tail FROM (SELECT * FROM changes WHERE delta > 0 ORDER BY delta DESC, country_code, genre LIMIT 25)
UNION ALL SELECT *, 'falling' AS tail FROM (SELECT * FROM changes WHERE delta < 0 ORDER BY delta, country_code, genre LIMIT 25)"""
)
def trending_tails(spark, sf_dir):
    return market.trending_tails(_w(spark, sf_dir))


@query(CHANGES + "SELECT * FROM changes")
def lag_delta(spark, sf_dir):
    return market.genre_changes(_w(spark, sf_dir))


IMAGES = """one AS (SELECT s_name AS artist_name, 'http://img/' || s_suppkey AS image FROM supplier WHERE s_suppkey % 3 = 0),
two AS (SELECT s_name AS artist_name, 'https://img/b' || s_suppkey || '?width=250' AS image FROM supplier WHERE s_suppkey % 2 = 0),
pictures AS (SELECT coalesce(one.artist_name, two.artist_name) AS artist_name, coalesce(one.image, two.image) AS image FROM one FULL OUTER JOIN two ON one.artist_name = two.artist_name)"""

SUMMARIES = (
    DOMESTIC
    + f""", {IMAGES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY score DESC, genre) AS p, row_number() OVER (PARTITION BY country_code ORDER BY distinctiveness DESC, genre) AS d FROM latest_genres),
tops AS (SELECT country_code, artist_name, row_number() OVER (PARTITION BY country_code ORDER BY best_position) AS r FROM current_streams)
SELECT n_name AS country_code, (SELECT count(*) FROM tops t WHERE t.country_code = n_name) AS artist_count,
       coalesce((SELECT string_agg(genre, ',' ORDER BY p) FROM ranked r WHERE r.country_code = n_name AND p <= 3), '') AS top_genres,
       coalesce((SELECT string_agg(genre, ',' ORDER BY d) FROM ranked r WHERE r.country_code = n_name AND d <= 3 AND distinctiveness > 0), '') AS distinctive_genres,
       coalesce((SELECT string_agg(artist_name, ',' ORDER BY r) FROM tops t WHERE t.country_code = n_name AND r <= 5), '') AS top_artists,
       domestic_percentage, coverage_percentage, (SELECT arg_min(image, r) FROM tops t JOIN pictures p ON t.artist_name = p.artist_name WHERE t.country_code = n_name AND r <= 5) AS cover_image
FROM nation LEFT JOIN domestic d ON d.country_code = n_name"""
)


@query(SUMMARIES)
def country_summaries(spark, sf_dir):
    return _flat_summaries(market.country_summaries(_w(spark, sf_dir), artist_images(spark, sf_dir)))


def _flat_summaries(summaries: DataFrame) -> DataFrame:
    joined = [F.array_join(c, ",").alias(c) for c in ("top_genres", "distinctive_genres", "top_artists")]
    return summaries.select("country_code", "artist_count", *joined, "domestic_share.domestic_percentage", "domestic_share.coverage_percentage", "cover_image")


PERCENTAGES = """+ percentages AS (SELECT country_code, genre, round(100.0::DOUBLE * score / sum(score) OVER (PARTITION BY country_code), 2) AS percentage FROM latest_genres WHERE score > 0)"""


@query(
    PERCENTAGES
    + """ SELECT a.country_code AS country_a, b.country_code AS country_b, floor(round(sum(least(a.percentage, b.percentage)), 6) * 10 + 0.5) / 10 AS similarity
FROM percentages a JOIN percentages b ON a.genre = b.genre AND a.country_code < b.country_code GROUP BY ALL"""
)
def compare_all(spark, sf_dir):
    return market.compare_all(_w(spark, sf_dir))


@query(
    PERCENTAGES
    + """ SELECT *, floor(round(left_pct - right_pct, 6) * 10 + 0.5) / 10 AS diff FROM (
  SELECT coalesce(a.genre, b.genre) AS genre, coalesce(a.percentage, 0.0::DOUBLE) AS left_pct, coalesce(b.percentage, 0.0::DOUBLE) AS right_pct
  FROM (SELECT * FROM percentages WHERE country_code = 'NATION_1') a FULL OUTER JOIN (SELECT * FROM percentages WHERE country_code = 'NATION_2') b ON a.genre = b.genre)
ORDER BY abs(diff) DESC, genre LIMIT 10"""
)
def compare_two(spark, sf_dir):
    return market.compare_two(_w(spark, sf_dir), "NATION_1", "NATION_2")


@query("""
, leaders AS (SELECT country_code, genre FROM latest_genres QUALIFY row_number() OVER (PARTITION BY country_code ORDER BY score DESC, genre) = 1),
classes AS (SELECT genre, CAST((row_number() OVER (ORDER BY count(*) DESC, genre) - 1) % 12 AS INTEGER) AS class FROM leaders GROUP BY genre)
SELECT country_code, class FROM leaders l JOIN classes c ON l.genre = c.genre""")
def choropleth_genre(spark, sf_dir):
    return market.choropleth(_w(spark, sf_dir), "genre")


@query(DOMESTIC + "SELECT country_code, CASE WHEN coverage_percentage >= 20 THEN CAST(least(floor(greatest(least(domestic_percentage, 100), 0) / 100 * 6), 5) AS INTEGER) END AS class FROM domestic")
def choropleth_domestic(spark, sf_dir):
    return market.choropleth(_w(spark, sf_dir), "domestic")


@query("""
SELECT a.artist_name, count(c.artist_name) AS chart_rows FROM artists a LEFT JOIN chart_entries c ON a.artist_name = c.artist_name WHERE resolved_at IS NULL GROUP BY 1 ORDER BY chart_rows DESC, a.artist_name LIMIT 250""")
def pending_artists(spark, sf_dir):
    return market.pending_artists(_history(spark, sf_dir))


# ---- single operators


@query("SELECT country_code, snapshot_date FROM latest_chart")
def latest_per_country(spark, sf_dir):
    return C.latest_days(_w(spark, sf_dir).chart_entries)


@query("SELECT country_code, snapshot_date, recency FROM recent_days")
def recency_dense_rank(spark, sf_dir):
    return C.recency(_history(spark, sf_dir).chart_entries)


@query("SELECT country_code, artist_name, streams, best_position, row_number() OVER (PARTITION BY country_code ORDER BY streams DESC, artist_name) AS rank FROM current_streams QUALIFY rank <= 3")
def topn_per_group(spark, sf_dir):
    return C.top(C.artist_streams(_w(spark, sf_dir).chart_entries), ["country_code"], [F.desc("streams"), F.asc("artist_name")], 3)


@query("""
SELECT coalesce(s.artist_name, l.artist_name) AS artist_name, s.plays, l.listeners FROM (SELECT artist_name, CAST(sum(streams) AS BIGINT) AS plays FROM current_streams GROUP BY 1) s
FULL OUTER JOIN (SELECT artist_name, CAST(sum(listeners) AS BIGINT) AS listeners FROM country_artist_listeners GROUP BY 1) l ON s.artist_name = l.artist_name""")
def full_outer_measures(spark, sf_dir):
    w = _w(spark, sf_dir)
    plays = C.artist_streams(w.chart_entries).groupBy("artist_name").agg(F.sum("streams").alias("plays"))
    return plays.join(w.country_artist_listeners.groupBy("artist_name").agg(F.sum("listeners").alias("listeners")), "artist_name", "full_outer")


@query("SELECT a.country_code AS country_a, b.country_code AS country_b, count(*) AS shared_genres FROM latest_genres a JOIN latest_genres b ON a.genre = b.genre AND a.country_code < b.country_code GROUP BY ALL")
def pair_self_join(spark, sf_dir):
    return market.similar_countries(_w(spark, sf_dir), limit=None).drop("genres_in_common")


@query(DOMESTIC + "SELECT country_code, domestic_streams, classified_streams, coverage_percentage FROM domestic")
def cond_sum_coverage(spark, sf_dir):
    return market.domestic_share(_w(spark, sf_dir)).select("country_code", "domestic_streams", "classified_streams", "coverage_percentage")


@query("SELECT genre, count(*) AS df FROM (SELECT *, sum(score) OVER (PARTITION BY country_code) AS t FROM latest_genres) WHERE score::DOUBLE / t::DOUBLE >= 0.01::DOUBLE GROUP BY 1")
def document_frequency(spark, sf_dir):
    return G.document_frequency(C.latest(_w(spark, sf_dir).country_genre_scores), ["country_code"])


LATEST_SCORED = """+ t AS (SELECT country_code, genre, score, sum(score) OVER (PARTITION BY country_code) AS total FROM latest_genres),
d AS (SELECT genre, count(*) AS df FROM t WHERE score::DOUBLE / total::DOUBLE >= 0.01::DOUBLE GROUP BY 1), n AS (SELECT count(DISTINCT country_code) AS n FROM t)"""


@query(LATEST_SCORED + "SELECT country_code, t.genre, score, CASE WHEN score::DOUBLE / total::DOUBLE >= 0.01::DOUBLE AND df > 0 THEN round(score * ln(n / df), 3) ELSE 0.0::DOUBLE END AS distinctiveness FROM t LEFT JOIN d ON t.genre = d.genre CROSS JOIN n")
def tfidf_distinctiveness(spark, sf_dir):
    latest = C.latest(_w(spark, sf_dir).country_genre_scores).select("country_code", "genre", "score")
    return G.distinctiveness(latest, ["country_code"])


@query("SELECT country_code, count(*) AS total_tags, count(*) FILTER (bucket = 'other') AS unclassified_tags, round(count(*) FILTER (bucket = 'other') / count(*), 4) AS unclassified_rate FROM known_tags GROUP BY 1")
def tag_coverage(spark, sf_dir):
    return G.coverage(_history(spark, sf_dir).scored[2], ["country_code"])


@query("""
, rates AS (SELECT country_code, round(count(*) FILTER (bucket = 'other') / count(*), 4) AS rate FROM known_tags GROUP BY 1)
SELECT (SELECT count(*) FROM nation) AS countries, round(avg(rate), 4) AS average_rate, coalesce((SELECT string_agg(n_name, ',' ORDER BY n_name) FROM nation WHERE n_name NOT IN (SELECT country_code FROM rates)), '') AS empty_countries,
       coalesce(string_agg(country_code, ',' ORDER BY rate DESC, country_code) FILTER (rate > 0.2), '') AS poorly_classified FROM rates""")
def quality_report(spark, sf_dir):
    rates = tag_coverage(spark, sf_dir)
    names = testview.tables(spark, sf_dir)("nation").select(F.col("n_name").alias("country_code"))
    counts = names.join(rates.select("country_code", F.lit(1).alias("artist_count")), "country_code", "left").withColumn("artist_count", F.coalesce("artist_count", F.lit(0)))
    report = G.quality_report(rates, counts, G.Params(unclassified_alarm=0.2))
    return report.select("countries", "average_rate", F.array_join("empty_countries", ",").alias("empty_countries"), F.array_join("poorly_classified", ",").alias("poorly_classified"))


@query("SELECT country_code, snapshot_date, genre, score, array_to_string(sources, ',') AS sources, distinctiveness FROM country_genre_scores")
def weighted_vote(spark, sf_dir):
    scores = _history(spark, sf_dir).country_genre_scores
    return scores.withColumn("sources", F.array_join("sources", ","))


@query("SELECT tag, coalesce(bucket, 'other') AS bucket FROM (SELECT DISTINCT tag FROM raw_tags) LEFT JOIN tag_bucket USING (tag)")
def bucket_containment(spark, sf_dir):
    named = testview.tags(_history(spark, sf_dir).lines).select(F.col("tag").alias("genre"))
    none = spark.createDataFrame([], "keyword string, bucket string, priority int")
    return G.bucketed(named, testview.noun_buckets(spark, sf_dir), none, fuzzy=False).select(F.col("genre").alias("tag"), "bucket")


@query(r"SELECT l_orderkey, l_linenumber, TRY_CAST(regexp_extract(replace(cell, ',', ''), '-?\d+') AS BIGINT) AS number FROM (SELECT *, CASE l_linenumber % 4 WHEN 0 THEN '+' || l_orderkey || ',' || l_partkey WHEN 1 THEN '(x' || l_suppkey || ')' WHEN 2 THEN '-' ELSE '-' || l_partkey END AS cell FROM lineitem)", views=False)
def parse_number(spark, sf_dir):
    kind, s = F.col("l_linenumber") % 4, lambda c: F.col(c).cast("string")
    cell = F.when(kind == 0, F.concat(F.lit("+"), s("l_orderkey"), F.lit(","), s("l_partkey"))).when(kind == 1, F.concat(F.lit("(x"), s("l_suppkey"), F.lit(")"))).when(kind == 2, "-").otherwise(F.concat(F.lit("-"), s("l_partkey")))
    return testview.tables(spark, sf_dir)("lineitem").select("l_orderkey", "l_linenumber", X.number(cell).alias("number"))


LABEL = "CASE doc_id % 3 WHEN 0 THEN {line} || ' - ' || doc_id WHEN 1 THEN {line} || '-' || doc_id ELSE {line} END"


@query(
    r"""
WITH l AS (SELECT doc_id, text AS line FROM documents),
b AS (SELECT doc_id, """
    + LABEL.format(line="line")
    + r""" AS label FROM l)
SELECT doc_id, nullif(trim(CASE WHEN contains(label, ' - ') THEN split_part(label, ' - ', 1) WHEN contains(label, '-') THEN split_part(label, '-', 1) ELSE label END, E' \t\n\r\x0b\x0c'), '') AS artist,
       nullif(trim(CASE WHEN contains(label, ' - ') THEN substr(label, instr(label, ' - ') + 3) WHEN contains(label, '-') THEN substr(label, instr(label, '-') + 1) END, E' \t\n\r\x0b\x0c'), '') AS track FROM b""",
    views=False,
)
def artist_label_split(spark, sf_dir):
    """Whole texts as labels, with a dash of each kind put behind two thirds of them."""
    docs = testview.tables(spark, sf_dir)("documents").select("doc_id", F.col("text").alias("line"))
    label = docs.select("doc_id", F.expr(LABEL.format(line="line")).alias("label"))
    return label.select("doc_id", X.label_artist(F.col("label")).alias("artist"), X.label_track(F.col("label")).alias("track"))


TAG = "CASE l_linenumber % 4 WHEN 0 THEN ' ' || substr(CAST(l_orderkey + 1900 AS VARCHAR(20)), 1, 4) || 's ' WHEN 1 THEN 'UK' WHEN 2 THEN CAST(l_partkey AS VARCHAR(20)) ELSE ' Part ' || l_partkey END"


@query(rf"SELECT l_orderkey, l_linenumber, CASE WHEN length(t) > 2 AND NOT regexp_full_match(t, '\d{{2,4}}s?') THEN t END AS tag FROM (SELECT *, lower(trim({TAG})) AS t FROM lineitem)", views=False)
def junk_tag_filter(spark, sf_dir):
    rows = testview.tables(spark, sf_dir)("lineitem").select("l_orderkey", "l_linenumber", F.expr(TAG.replace("VARCHAR(20)", "STRING")).alias("raw"))
    return rows.select("l_orderkey", "l_linenumber", X.clean_tag(F.col("raw")).alias("tag"))


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    views=False,
)
def dedupe_last_wins(spark, sf_dir):
    orders = testview.tables(spark, sf_dir)("orders").select("o_custkey", "o_orderkey", "o_totalprice", F.struct("o_orderdate", "o_orderkey").alias("pos"))
    return C.dedupe_last(orders, ["o_custkey"], "pos").drop("pos")


@query("SELECT DISTINCT artist_name FROM (SELECT artist_name FROM chart_entries UNION ALL SELECT artist_name FROM country_artist_listeners)")
def union_dimension(spark, sf_dir):
    w = _history(spark, sf_dir)
    return C.artist_names(w.chart_entries, w.country_artist_listeners)


@query("SELECT DISTINCT artist_name FROM chart_entries WHERE artist_name NOT IN (SELECT artist_name FROM artists WHERE resolved_at IS NOT NULL)")
def pending_anti_join(spark, sf_dir):
    w = _history(spark, sf_dir)
    return C.pending(w.chart_entries.select("artist_name").distinct(), w.artists.where("resolved_at is not null"), "artist_name")


@query("""
SELECT coalesce(o.artist_name, n.artist_name) AS artist_name, CASE WHEN o.artist_name IS NULL THEN n.fans WHEN n.artist_name IS NOT NULL THEN n.fans ELSE o.fans END AS fans, o.origin_country
FROM (SELECT * FROM artists WHERE resolved_at IS NOT NULL) o FULL OUTER JOIN (SELECT artist_name, fans + 1 AS fans, 'XX' AS origin_country FROM artists WHERE origin_country IS NULL OR resolved_at IS NULL) n ON o.artist_name = n.artist_name
WHERE o.artist_name IS NOT NULL
UNION ALL SELECT artist_name, fans + 1, 'XX' FROM artists WHERE resolved_at IS NULL""")
def merge_dimension(spark, sf_dir):
    every = _w(spark, sf_dir).artists
    old = every.where("resolved_at is not null").select("artist_name", "fans", "origin_country")
    new = every.where("origin_country is null or resolved_at is null").select("artist_name", (F.col("fans") + 1).alias("fans"), F.lit("XX").alias("origin_country"))
    return sinks.merged(old, new, "artist_name", ["fans"])


@query(PERCENTAGES + "SELECT country_code, genre, percentage, CAST(least(floor(percentage / 100 * 6), 5) AS INTEGER) AS band FROM percentages")
def percentage_bands(spark, sf_dir):
    return market.percentages(_w(spark, sf_dir)).withColumn("band", X.share_band(F.col("percentage")))


@query(
    """
WITH codes AS (SELECT lower(substr(n_name, 1, 2) || n_nationkey) AS code, upper(substr(n_name, 1, 3) || n_nationkey) AS alpha3, n_nationkey AS number FROM nation)
SELECT c_custkey AS feature_id, CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE code END AS code FROM customer JOIN codes ON c_nationkey = number""",
    views=False,
)
def code_resolution(spark, sf_dir):
    t = testview.tables(spark, sf_dir)
    two, three = F.concat(F.substring("n_name", 1, 2), F.col("n_nationkey").cast("string")), F.upper(F.concat(F.substring("n_name", 1, 3), F.col("n_nationkey").cast("string")))
    codes = t("nation").select("n_nationkey", F.lower(two).alias("alpha2"), three.alias("alpha3"), F.col("n_nationkey").alias("number"))
    met = t("customer").join(F.broadcast(codes), F.col("c_nationkey") == F.col("n_nationkey"))
    none, kind = F.lit("-99"), F.col("c_custkey") % 5
    given = F.when(kind == 0, F.array(F.col("alpha2"), none)).when(kind == 1, F.array(none, F.col("alpha3"))).when(kind == 2, F.array(none, none, F.col("number").cast("string"))).when(kind == 3, F.array(F.lit("?"), F.lower("alpha3"), F.col("alpha2"))).otherwise(F.array(none, F.lit("?")))
    return matching.resolved_codes(met.select(F.col("c_custkey").alias("feature_id"), given.alias("candidates")), codes.drop("n_nationkey"))


@query(PERCENTAGES + "SELECT a.country_code AS country_a, b.country_code AS country_b, floor(round(sum(least(a.percentage, b.percentage)), 6) * 10 + 0.5) / 10 AS similarity FROM percentages a JOIN percentages b ON a.genre = b.genre AND a.country_code < b.country_code GROUP BY ALL")
def histogram_overlap(spark, sf_dir):
    return compare.overlap_all(market.percentages(_w(spark, sf_dir)))


@query("""
SELECT c.country_code, track_name, position FROM chart_entries c JOIN latest_chart l ON c.country_code = l.country_code AND c.snapshot_date = l.snapshot_date WHERE position <= 100""")
def chart_from_html(spark, sf_dir):
    """The latest charts rendered as pages, then read back from their first table, which gives its first 100 lines."""
    entries = C.latest(_w(spark, sf_dir).chart_entries)
    cell = lambda c: F.concat(F.lit("<td> "), c, F.lit(" </td>"))
    row = F.concat(F.lit("<tr>"), cell(F.col("position").cast("string")), cell(F.lit("=")), cell(F.concat(F.lit("<a href='#'>"), F.replace("artist_name", F.lit("-"), F.lit("_")), F.lit("</a> - "), F.col("track_name"))), F.lit("</tr>"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("position", row.alias("row")))), lambda x: x["row"])
    head = F.lit("<html><table><tr><th>Pos</th></tr>")
    pages = entries.groupBy("country_code").agg(F.concat(head, F.array_join(rows, "\n"), F.lit("</table><table><tr><td>9</td></tr></table></html>")).alias("html"))
    return raw.chart_pages(pages).select("country_code", "track_name", "position")


@query("SELECT CAST(page_id AS VARCHAR) AS country_code, page_id % 100 + 1 AS position, 'P' || page_id AS artist_name, 'T' || page_id AS track_name FROM pages", views=False)
def charts_in_pages(spark, sf_dir):
    """Web pages with a chart of one line put before their own markup."""
    code = F.col("page_id").cast("string")
    cells = F.concat(F.lit("<td>"), (F.col("page_id") % 100 + 1).cast("string"), F.lit("</td><td>=</td><td><b>P"), code, F.lit("</b> - T"), code, F.lit("</td>"))
    html = F.concat(F.lit("<body><table><tr><th>Pos</th></tr><tr>"), cells, F.lit("</tr></table>"), F.coalesce("html", F.lit("")), F.lit("</body>"))
    pages = testview.tables(spark, sf_dir)("pages").select(code.alias("country_code"), html.alias("html"))
    return raw.chart_pages(pages).select("country_code", "position", "artist_name", "track_name")


@query("SELECT DISTINCT genre FROM latest_genres WHERE genre <> 'other' AND length(genre) % 3 <> 0")
def genre_worklist(spark, sf_dir):
    """Genres without a description; those whose names have 3, 6, ... letters have one."""
    scores = C.latest(_w(spark, sf_dir).country_genre_scores)
    return refresh.genre_worklist(scores.select("genre").unionByName(scores.select(F.lit("other").alias("genre"))), scores.where(F.length("genre") % 3 == 0))


@query("SELECT count(DISTINCT c.artist_name) AS wanted, count(DISTINCT l.artist_name) AS matched FROM current_streams c LEFT JOIN (SELECT DISTINCT artist_name FROM country_artist_listeners) l ON c.artist_name = l.artist_name")
def matched_artists(spark, sf_dir):
    w = _w(spark, sf_dir)
    return refresh.matched(C.latest(w.chart_entries), w.country_artist_listeners, "artist_name")


@query(
    """
WITH c AS (SELECT c_nationkey, c_custkey, c_name, c_acctbal FROM customer)
SELECT n_name AS query, c_custkey AS id, CAST(floor(c_acctbal) AS BIGINT) AS nb_fan FROM nation JOIN c ON n_nationkey = c_nationkey
WHERE c_custkey % 3 = 0 QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY floor(c_acctbal) DESC, c_custkey) = 1""",
    views=False,
)
def match_candidates(spark, sf_dir):
    """Customers offered for their nation's name: every third under that name, in capitals and with an accent, others under a longer one."""
    t = testview.tables(spark, sf_dir)
    met = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), F.lower("n_name"), F.lit("́ "))).otherwise(F.concat("n_name", F.lit(" (UK)")))
    none = F.lit(None).cast("string")
    offered = met.select(F.col("n_name").alias("query"), F.col("c_custkey").alias("pos"), F.col("c_custkey").alias("id"), name.alias("name"), F.floor("c_acctbal").alias("nb_fan"), none.alias("picture_medium"), none.alias("picture_big"))
    return matching.best_candidates(offered).select("query", "id", "nb_fan")


@query()
def name_keys(spark, sf_dir):
    """The keys of whole texts; a test holds keys against the standard library."""
    return testview.tables(spark, sf_dir)("documents").select(F.col("text").alias("name")).distinct().select("name", name_key("name").alias("key"))


def _lcs(a: str, b: str) -> str:
    """DuckDB text of the length of the longest common subsequence: one row of the table after the other."""
    step = f"CASE WHEN substr({a}, x[1], 1) = substr({b}, y[1], 1) THEN line[y[1]] + 1 ELSE greatest(line[y[1] + 1], cells[y[1]]) END"
    line = f"list_reduce(list_prepend([0::BIGINT], list_transform(range(1, length({b}) + 1), lambda j: [j])), lambda cells, y: list_append(cells, {step}))"
    return f"list_reduce(list_prepend(list_transform(range(length({b}) + 1), lambda z: 0::BIGINT), list_transform(range(1, length({a}) + 1), lambda i: [i])), lambda line, x: {line})[length({b}) + 1]"


@query(
    f"""
WITH terms AS (SELECT p_name AS term, min(p_partkey) AS priority FROM part GROUP BY 1), texts AS (SELECT DISTINCT substr(p_name, 1, 3) || substr(p_name, 5) AS text FROM part),
scored AS (SELECT text, term, priority, 200.0::DOUBLE * {_lcs("text", "term")} / (length(text) + length(term)) AS score FROM texts, terms)
SELECT text, term, score FROM scored WHERE score >= 85 QUALIFY row_number() OVER (PARTITION BY text ORDER BY score DESC, priority) = 1""",
    views=False,
)
def fuzzy_match(spark, sf_dir):
    """Part names with one letter lost, against the part names."""
    part = testview.tables(spark, sf_dir)("part")
    terms = part.groupBy(F.col("p_name").alias("term")).agg(F.min("p_partkey").alias("priority"))
    broken = part.select(F.concat(F.substring("p_name", 1, 3), F.expr("substr(p_name, 5)")).alias("text")).distinct()
    return G.nearest_terms(broken, terms, 85)


def _listed(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


WORD = """CASE l_orderkey % 7 WHEN 0 THEN ' ' || upper(b) || ' ' WHEN 1 THEN CASE WHEN length(b) > 6 THEN substr(b, 1, 3) || substr(b, 5) ELSE b END WHEN 2 THEN 'zz ' || k || 'y' WHEN 3 THEN a WHEN 4 THEN '80s'
WHEN 5 THEN substr(b, 1, 2) || substr(b, 2) ELSE 'xqj' || (l_linenumber + l_suppkey % 10) END"""

#: Tags that are spelling variants of the real lists, and what each tier makes of them; half of the buckets are the canonical terms.
WORDS = rf"""+ numbered_lines AS (SELECT *, (l_orderkey * 7 + l_linenumber) AS n FROM lines JOIN latest_chart USING (country_code, snapshot_date)),
spelt AS (SELECT country_code, artist_name, l_orderkey, l_linenumber, p_size, {WORD} AS tag FROM (SELECT *, {_listed(vocabulary.BUCKETS)}[n % {len(vocabulary.BUCKETS)} + 1] AS b,
          {_listed([k for k, _ in vocabulary.KEYWORDS])}[n % {len(vocabulary.KEYWORDS)} + 1] AS k, {_listed(sorted(vocabulary.ALIASES))}[n % {len(vocabulary.ALIASES)} + 1] AS a FROM numbered_lines)),
bucket_list AS (SELECT unnest({_listed(vocabulary.BUCKETS)}) AS bucket, unnest(range({len(vocabulary.BUCKETS)})) AS priority),
keyword_list AS (SELECT unnest({_listed([k for k, _ in vocabulary.KEYWORDS])}) AS keyword, unnest({_listed([v for _, v in vocabulary.KEYWORDS])}) AS bucket, unnest(range({len(vocabulary.KEYWORDS)})) AS priority),
alias_list AS (SELECT unnest({_listed(list(vocabulary.ALIASES))}) AS tag, unnest({_listed(list(vocabulary.ALIASES.values()))}) AS alias),
plain AS (SELECT tag, CASE WHEN length(t) > 2 AND NOT regexp_full_match(t, '\d{{2,4}}s?') THEN t END AS t FROM (SELECT DISTINCT tag, lower(trim(tag)) AS t FROM spelt)),
open_words AS (SELECT DISTINCT t FROM plain WHERE t IS NOT NULL AND t NOT IN (SELECT tag FROM alias_list)),
near_term AS (SELECT t, bucket AS term FROM (SELECT t, bucket, priority, CASE WHEN t = bucket THEN 200 ELSE 200.0::DOUBLE * {_lcs("t", "bucket")} / (length(t) + length(bucket)) END AS score
              FROM open_words, bucket_list WHERE priority % 2 = 0 AND length(t) < 2 * length(bucket) AND length(bucket) < 2 * length(t)) WHERE score >= 85 QUALIFY row_number() OVER (PARTITION BY t ORDER BY score DESC, priority) = 1),
named_words AS (SELECT p.tag, p.t, coalesce(alias, term, p.t) AS genre FROM plain p LEFT JOIN alias_list a ON p.t = a.tag LEFT JOIN near_term n ON p.t = n.t),
by_rule AS (SELECT genre, arg_min(bucket, (tier, size, priority)) AS bucket FROM (
  SELECT genre, bucket, CASE WHEN genre = bucket THEN 0 ELSE 1 END AS tier, -length(bucket) AS size, priority FROM (SELECT DISTINCT genre FROM named_words) JOIN bucket_list ON contains(genre, bucket)
  UNION ALL SELECT genre, bucket, 2, 0, priority FROM (SELECT DISTINCT genre FROM named_words) JOIN keyword_list ON contains(genre, keyword)) GROUP BY 1),
by_likeness AS (SELECT genre, bucket FROM (SELECT genre, bucket, priority, 200.0::DOUBLE * {_lcs("genre", "bucket")} / (length(genre) + length(bucket)) AS score
                FROM (SELECT DISTINCT genre FROM named_words WHERE genre IS NOT NULL AND genre NOT IN (SELECT genre FROM by_rule)), bucket_list WHERE length(genre) < 2 * length(bucket) AND length(bucket) < 2 * length(genre))
                WHERE score >= 88 QUALIFY row_number() OVER (PARTITION BY genre ORDER BY score DESC, priority) = 1),
word_bucket AS (SELECT tag, n.genre, CASE WHEN n.genre IS NOT NULL THEN coalesce(r.bucket, l.bucket, 'other') END AS bucket FROM named_words n LEFT JOIN by_rule r ON n.genre = r.genre LEFT JOIN by_likeness l ON n.genre = l.genre)"""


def _spelt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest lines as tags of both sources that are spelling variants, keywords and one-letter errors of the real lists."""
    return _w(spark, sf_dir).once("spelt", lambda: sinks.kept(_misspelt(spark, sf_dir), testview.scratch(spark)))


def _misspelt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.latest(_w(spark, sf_dir).lines).withColumn("n", F.col("l_orderkey") * 7 + F.col("l_linenumber"))
    pick = lambda values: F.array(*map(F.lit, values))[(F.col("n") % len(values)).cast("int")]
    words = {"b": vocabulary.BUCKETS, "k": [k for k, _ in vocabulary.KEYWORDS], "a": sorted(vocabulary.ALIASES)}
    spelt = rows.select("*", *[pick(v).alias(c) for c, v in words.items()]).withColumn("tag", F.expr(WORD))
    odd = F.col("l_linenumber") % 2 == 1
    source = F.when(odd, "a").otherwise("b")
    order = Window.partitionBy("country_code", "artist_name", "source").orderBy("l_orderkey", "l_linenumber")
    return spelt.withColumn("source", source).select("country_code", "artist_name", (F.row_number().over(order) - 1).alias("pos"), "tag", F.when(odd, (F.col("p_size") * 2).cast("string")).alias("count"), "source")


def _half_terms(spark: SparkSession) -> DataFrame:
    return G.bucket_table(spark).where("priority % 2 = 0").withColumnRenamed("bucket", "term")


@query(WORDS + " SELECT tag, genre, bucket FROM word_bucket")
def tag_tiers(spark, sf_dir):
    """Every tier of naming and bucketing: junk, alias, nearest term; exact, contained, keyword, nearest bucket, other."""
    named = G.normalised_tags(_spelt(spark, sf_dir), _half_terms(spark))
    return named.join(G.bucketed(named.where("genre is not null").select("genre")), "genre", "left").select("tag", "genre", "bucket")


@query(
    WORDS
    + """, numbered AS (SELECT *, row_number() OVER (PARTITION BY country_code, artist_name, l_linenumber % 2 ORDER BY l_orderkey, l_linenumber) - 1 AS pos FROM spelt),
t AS (SELECT *, sum(score) OVER (PARTITION BY country_code) AS total FROM (
  SELECT country_code, bucket AS genre, CAST(sum(greatest(floor(CASE WHEN l_linenumber % 2 = 1 THEN p_size * 2 ELSE 20 END / 20), 1)) AS BIGINT) AS score FROM numbered JOIN word_bucket USING (tag) WHERE pos < 5 AND bucket <> 'other' GROUP BY ALL)),
d AS (SELECT genre, count(*) AS df FROM t WHERE score::DOUBLE / total::DOUBLE >= 0.01::DOUBLE GROUP BY 1), n AS (SELECT count(DISTINCT country_code) AS n FROM t)
SELECT country_code, t.genre, score, CASE WHEN score::DOUBLE / total::DOUBLE >= 0.01::DOUBLE AND df > 0 THEN round(score * ln(n / df), 3) ELSE 0.0::DOUBLE END AS distinctiveness FROM t LEFT JOIN d ON t.genre = d.genre CROSS JOIN n"""
)
def cleanse_words(spark, sf_dir):
    """The cleansing plan with the real buckets, keywords and aliases, a canonical list, and fuzzy matching."""
    known = C.artist_streams(_w(spark, sf_dir).chart_entries).select("country_code", "artist_name", F.col("best_position").alias("rank"))
    done = refresh.cleanse(known, _spelt(spark, sf_dir), _w(spark, sf_dir).countries, _half_terms(spark), within=testview.scratch(spark))
    return done.scores.select("country_code", "genre", "score", "distinctiveness")


@query(f", {IMAGES} SELECT * FROM pictures")
def artist_images(spark, sf_dir):
    s = testview.tables(spark, sf_dir)("supplier").select(F.col("s_name").alias("artist_name"), "s_suppkey")
    code = F.col("s_suppkey").cast("string")
    empty = F.concat(F.lit("http://img/"), F.lit(X.EMPTY_PICTURE))
    one = s.select("artist_name", X.picture(empty, F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("http://img/"), code)).otherwise(empty)).alias("image"))
    two = s.where("s_suppkey % 2 = 0").select("artist_name", X.thumbnail(F.concat(F.lit("http://img/b"), code)).alias("image"))
    return matching.images(one, two)


@query("""
SELECT s_name AS artist_name, 'm' || s_suppkey AS mbid FROM supplier WHERE s_suppkey % 3 <> 0 AND s_suppkey % 7 <> 0 AND s_suppkey % 2 = 0""")
def images_needed(spark, sf_dir):
    s = testview.tables(spark, sf_dir)("supplier").select(F.col("s_name").alias("artist_name"), "s_suppkey")
    mbids = s.select("artist_name", F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("m"), F.col("s_suppkey").cast("string"))).alias("mbid"))
    return refresh.images_needed(s, mbids, s.where("s_suppkey % 3 = 0"), s.where("s_suppkey % 7 = 0"))


@query(
    r"""
WITH d AS (SELECT page_id, 'g' || page_id AS genre, html FROM pages), c AS (SELECT genre, regexp_replace(regexp_replace(CASE WHEN regexp_matches(html, '<a\s') THEN regexp_extract(html, '(?s)^(.*?)<a\s', 1) ELSE html END, '<[^>]+>', '', 'g'), '^\s+|[\s.]+$', '', 'g') AS t FROM d)
SELECT genre, CASE WHEN t <> '' THEN t || '.' END AS summary FROM c""",
    views=False,
)
def describe_genres(spark, sf_dir):
    pages = testview.tables(spark, sf_dir)("pages").select(F.concat(F.lit("g"), F.col("page_id").cast("string")).alias("genre"), "html", "url")
    return refresh.described_genres(pages, "2001-01-01").select("genre", "summary")


@query("""
SELECT s_name AS artist_name, CASE WHEN s_suppkey % 4 = 0 THEN lower(n_name) WHEN s_suppkey % 4 = 1 THEN 'n' || s_suppkey END AS origin_country,
       CASE WHEN s_suppkey % 4 IN (0, 1) THEN 'hit' WHEN s_suppkey % 4 = 2 THEN 'error' ELSE 'miss' END AS status FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def resolve_artists(spark, sf_dir):
    """A quarter of the suppliers is known by id, one by name, one's search failed, one isn't known at all."""
    t = testview.tables(spark, sf_dir)
    s = t("supplier").join(F.broadcast(t("nation")), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("artist_name"), "s_suppkey", "n_name", (F.col("s_suppkey") % 4).alias("kind"))
    code, pos = F.col("s_suppkey").cast("string"), F.col("s_suppkey").alias("pos")
    mbids = s.where("kind = 0").select("artist_name", F.concat(F.lit("m"), code).alias("mbid"), pos)
    rows = s.where("kind = 0").select(F.concat(F.lit("m"), code).alias("mbid"), pos, F.col("n_name").alias("iso"), F.lit("1985-01-01").alias("inception"))
    named = s.where("kind = 1").select(F.col("artist_name").alias("name"), F.concat(F.lit("Q"), code).alias("item"), pos, F.concat(F.lit("N"), code).alias("iso"), F.lit(None).cast("string").alias("inception"))
    none = F.lit(None).cast("string")
    searched = s.where("kind >= 2").select("artist_name", none.alias("mbid"), none.alias("origin_country"), F.lit(None).cast("bigint").alias("formed_year"), (F.col("kind") == 2).alias("failed"))
    return matching.resolve(s, mbids, matching.entity_meta(rows, "mbid"), matching.entity_meta_by_name(named), searched).select("artist_name", "origin_country", "status")


def _on(facts: DataFrame, recency: int) -> DataFrame:
    """The rows of each country's latest day (1) or of the one before (2)."""
    return C.recent(facts).where(F.col("recency") == recency).drop("recency")


def _cleansed(spark: SparkSession, sf_dir: str, recency: int = 1) -> refresh.Cleansed:
    """Every country's latest day, or the one before, through the whole cleansing plan; once for a session's view."""
    return _w(spark, sf_dir).once(f"cleansed {recency}", lambda: _cleanse(spark, sf_dir, recency))


def _cleanse(spark: SparkSession, sf_dir: str, recency: int) -> refresh.Cleansed:
    w = _w(spark, sf_dir)
    tags = testview.tags(_on(w.lines, recency))
    best = _on(w.chart_entries, recency).groupBy("country_code", "artist_name").agg(F.min("position").alias("p"))
    known = best.select("country_code", "artist_name", F.row_number().over(Window.partitionBy("country_code").orderBy("p")).cast("bigint").alias("rank"))
    none = spark.createDataFrame([], "keyword string, bucket string, priority int")
    values = testview.tables(spark, sf_dir)("part").select(F.col("p_name").alias("tag"))  # every tag is a part's name
    return refresh.cleanse(known, tags, w.countries, None, testview.noun_buckets(spark, sf_dir), none, fuzzy=False, within=testview.scratch(spark), values=values)


@query(LATEST_SCORED + "SELECT country_code, t.genre, score, CASE WHEN score::DOUBLE / total::DOUBLE >= 0.01::DOUBLE AND df > 0 THEN round(score * ln(n / df), 3) ELSE 0.0::DOUBLE END AS distinctiveness FROM t LEFT JOIN d ON t.genre = d.genre CROSS JOIN n")
def cleanse(spark, sf_dir):
    return _cleansed(spark, sf_dir).scores.select("country_code", "genre", "score", "distinctiveness")


RECORDS = """
, g AS (SELECT country_code, string_agg(genre || ':' || score, ',' ORDER BY score DESC, genre) AS genres FROM latest_genres GROUP BY 1),
a AS (SELECT country_code, count(*) AS artist_count, string_agg(artist_name, ',' ORDER BY best_position) AS artists FROM current_streams GROUP BY 1)
SELECT a.country_code, artist_count, artists, genres FROM a LEFT JOIN g ON a.country_code = g.country_code"""


def _record_text(rows: DataFrame) -> DataFrame:
    genres = F.array_join(F.transform("genres", lambda x: F.concat_ws(":", x["genre"], x["score"].cast("string"))), ",")
    return rows.select("country_code", F.col("artist_count").cast("bigint"), F.array_join("artists", ",").alias("artists"), genres.alias("genres"))


@query(RECORDS)
def processed_records(spark, sf_dir):
    return _record_text(refresh.records(_cleansed(spark, sf_dir)))


@query(RECORDS)
def stored_records(spark, sf_dir):
    """Records stored for two days, the first of them twice, and each country's latest one read back from the history."""
    root = f"{testview.scratch(spark)}/records"
    rows = refresh.records(_cleansed(spark, sf_dir))
    old = rows.withColumn("artist_count", F.lit(0))
    for day, found in (("2001-06-30", old), ("2001-06-30", old), ("2001-07-01", rows)):
        sinks.store_day({"records": found}, root, day)
    return _record_text(refresh.latest_records(sinks.stored(spark, root, "records", rows.schema)))


@query("""
, latest_known AS (SELECT k.* FROM known_tags k JOIN latest_chart l ON k.country_code = l.country_code AND k.snapshot_date = l.snapshot_date),
rates AS (SELECT country_code, count(*) AS total_tags, count(*) FILTER (bucket = 'other') AS unclassified_tags, round(count(*) FILTER (bucket = 'other') / count(*), 4) AS unclassified_rate FROM latest_known GROUP BY 1),
report AS (SELECT (SELECT count(*) FROM nation) AS countries, round(avg(unclassified_rate), 4) AS average_rate, coalesce((SELECT string_agg(n_name, ',' ORDER BY n_name) FROM nation WHERE n_name NOT IN (SELECT country_code FROM current_streams)), '') AS empty_countries,
                  coalesce(string_agg(country_code, ',' ORDER BY unclassified_rate DESC, country_code) FILTER (unclassified_rate > 0.5), '') AS poorly_classified FROM rates)
SELECT day AS snapshot_date, country_code, total_tags, unclassified_tags, unclassified_rate, countries, average_rate, empty_countries, poorly_classified, day + INTERVAL 6 HOUR AS generated_at
FROM rates, report, (SELECT unnest([DATE '2001-06-30', DATE '2001-07-01']) AS day)""")
def stored_quality(spark, sf_dir):
    """The quality report as stored with each of two days, the second stored twice, beside what it was made of."""
    root, done = f"{testview.scratch(spark)}/days", _cleansed(spark, sf_dir)
    for day in ("2001-06-30", "2001-07-01", "2001-07-01"):
        refresh.store(done, root, day, f"{day} 06:00:00")
    report = sinks.stored(spark, root, "quality", refresh.REPORT)
    joined = [F.array_join(c, ",").alias(c) for c in ("empty_countries", "poorly_classified")]
    report = report.select("snapshot_date", "countries", "average_rate", *joined, "generated_at")
    return sinks.stored(spark, root, "coverage", refresh.COVERAGE).join(report, "snapshot_date")


def _load(spark: SparkSession, sf_dir: str, root: str, day: str, recency: int) -> sinks.Counters:
    w = _w(spark, sf_dir)
    charts = _on(w.chart_entries, recency).drop("snapshot_date")
    heard = _on(w.country_artist_listeners, recency).select("country_code", "artist_name", "listeners", F.lit(0).alias("pos"))
    return refresh.load_snapshot(spark, root, day, _cleansed(spark, sf_dir, recency), w.countries, charts, heard, w.artists)


def _loaded(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse folder with one day loaded twice."""
    root = testview.scratch(spark)
    for _ in range(2):
        _load(spark, sf_dir, root, "2001-07-01", 1)
    return root


LOADED = """+ heard AS (SELECT l.* FROM country_artist_listeners l JOIN (SELECT country_code, max(snapshot_date) AS d FROM country_artist_listeners GROUP BY 1) m ON l.country_code = m.country_code AND l.snapshot_date = m.d),
charted AS (SELECT c.* FROM chart_entries c JOIN latest_chart l ON c.country_code = l.country_code AND c.snapshot_date = l.snapshot_date)"""


@query(
    LOADED
    + """ SELECT 'artists' AS name, (SELECT count(*) FROM (SELECT artist_name FROM heard UNION SELECT artist_name FROM charted)) AS n UNION ALL SELECT 'chart_entries', (SELECT count(*) FROM charted)
UNION ALL SELECT 'countries', (SELECT count(*) FROM nation) UNION ALL SELECT 'country_artist_listeners', (SELECT count(*) FROM heard) UNION ALL SELECT 'country_genre_scores', (SELECT count(*) FROM latest_genres)
UNION ALL SELECT 'country_snapshots', (SELECT count(DISTINCT country_code) FROM current_streams) UNION ALL SELECT 'country_top_artists', (SELECT count(*) FROM current_streams) UNION ALL SELECT 'genres', (SELECT count(DISTINCT genre) FROM latest_genres)"""
)
def load_snapshot(spark, sf_dir):
    root = _loaded(spark, sf_dir)
    names = ["artists", "chart_entries", "countries", "country_artist_listeners", "country_genre_scores", "country_snapshots", "country_top_artists", "genres"]
    out = None
    for name in names:
        counted = sinks.read_table(spark, f"{root}/{name}", name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = counted if out is None else out.unionByName(counted)
    return out


@query(
    LOADED
    + """, figures AS (
  SELECT (SELECT count(DISTINCT country_code) FROM current_streams) AS loaded, (SELECT count(*) FROM nation) AS countries, (SELECT count(*) FROM (SELECT artist_name FROM heard UNION SELECT artist_name FROM charted)) AS artists,
         (SELECT count(*) FROM artists WHERE fans IS NOT NULL AND artist_name IN (SELECT artist_name FROM heard UNION SELECT artist_name FROM charted)) AS with_fans)
SELECT unnest(['country_snapshots', 'country_genre_scores', 'country_top_artists', 'country_artist_genres', 'country_artist_listeners', 'chart_entries', 'countries', 'artists', 'genres', 'countries_loaded', 'countries_skipped', 'artists_with_fans', 'share_with_fans']) AS name,
       unnest([loaded, (SELECT count(*) FROM latest_genres), (SELECT count(*) FROM current_streams), (SELECT count(*) FROM country_artist_genres g JOIN latest_chart l ON g.country_code = l.country_code AND g.snapshot_date = l.snapshot_date),
               (SELECT count(*) FROM heard), (SELECT count(*) FROM charted), countries, artists, (SELECT count(DISTINCT genre) FROM latest_genres), loaded, countries - loaded, with_fans, round(with_fans / artists, 4)]::DOUBLE[]) AS value FROM figures"""
)
def run_counters(spark, sf_dir):
    """What a load counts while it writes."""
    found = refresh.run_summary(_load(spark, sf_dir, testview.scratch(spark), "2001-07-01", 1))
    return spark.createDataFrame([(name, float(n)) for name, n in found.items()], "name string, value double")


@query(LOADED + "SELECT lower(n_name) AS code, (SELECT count(*) FROM charted c WHERE c.country_code = n_name AND position <= 10) AS chart_rows FROM nation")
def publish(spark, sf_dir):
    """A loaded day published as JSON and read back by its country folders."""
    back = refresh.published(spark, _published(spark, sf_dir), "countries")
    return back.select("code", F.coalesce(F.size("chart"), F.lit(0)).cast("bigint").alias("chart_rows"))


def _published(spark: SparkSession, sf_dir: str) -> str:
    """The two latest days loaded, genres described, artists resolved, and all payloads published."""

    def make() -> str:
        root = testview.scratch(spark)
        for day, recency in (("2001-06-30", 2), ("2001-07-01", 1)):
            _load(spark, sf_dir, root, day, recency)
        seen = sinks.read_table(spark, f"{root}/genres", "genres").where(F.length("genre") % 3 == 0)
        captured = seen.select("genre", F.concat(F.lit("<p>About "), "genre", F.lit("</p> <a href='#'>more</a>")).alias("html"), F.concat(F.lit("http://g/"), "genre").alias("url"))
        sinks.merge_dimension(refresh.described_genres(captured, "2001-01-01"), f"{root}/genres", "genres", ["summary", "url", "resolved_at"])
        origins = _w(spark, sf_dir).artists.where("origin_country is not null").select("artist_name", F.lit(None).cast("string").alias("mbid"), "origin_country", F.lit(None).cast("bigint").alias("formed_year"), F.lit("hit").alias("status"))
        refresh.store_resolved(origins, root, "2001-01-01")
        refresh.publish(refresh.warehouse(spark, root), f"{root}/published", artist_images(spark, sf_dir))
        return f"{root}/published"

    return _w(spark, sf_dir).once("published", make)


#: A loaded day's genres are scored against all countries' loaded days, as the cleansing does, not by quarter as the view does.
RESCORED = """+ with_total AS (SELECT *, sum(score) OVER (PARTITION BY country_code) AS total FROM latest_genres),
in_countries AS (SELECT genre, count(*) AS df FROM with_total WHERE score::DOUBLE / total::DOUBLE >= 0.01::DOUBLE GROUP BY 1),
rescored AS (SELECT country_code, t.genre, score, sources, CASE WHEN score::DOUBLE / total::DOUBLE >= 0.01::DOUBLE AND df > 0 THEN round(score * ln((SELECT count(DISTINCT country_code) FROM with_total) / df), 3) ELSE 0.0::DOUBLE END AS distinctiveness
  FROM with_total t LEFT JOIN in_countries d ON t.genre = d.genre)"""


def _rescored(sql: str) -> str:
    return f"{RESCORED}, {sql.lstrip().removeprefix('+').replace('latest_genres', 'rescored')}"


@query(_rescored(SUMMARIES))
def published_summaries(spark, sf_dir):
    return _flat_summaries(refresh.published(spark, _published(spark, sf_dir), "summaries"))


@query(ORACLE_SQL["global_artists"], views=False)
def published_ranking(spark, sf_dir):
    return refresh.published(spark, _published(spark, sf_dir), "global_artists")


@query(ORACLE_SQL["trending_genres"], views=False)
def published_trends(spark, sf_dir):
    return refresh.published(spark, _published(spark, sf_dir), "trending_genres")


DETAIL = """+ popular AS (
  SELECT coalesce(s.country_code, l.country_code) AS country_code, coalesce(s.artist_name, l.artist_name) AS artist, streams, listeners, fans,
         row_number() OVER (PARTITION BY coalesce(s.country_code, l.country_code) ORDER BY (streams IS NOT NULL AND listeners IS NOT NULL) DESC, streams DESC NULLS LAST, listeners DESC NULLS LAST, coalesce(s.artist_name, l.artist_name)) AS place
  FROM current_streams s FULL OUTER JOIN (
    SELECT l.* FROM country_artist_listeners l JOIN (SELECT country_code, max(snapshot_date) AS d FROM country_artist_listeners GROUP BY 1) m ON l.country_code = m.country_code AND l.snapshot_date = m.d) l
    ON s.country_code = l.country_code AND s.artist_name = l.artist_name
  LEFT JOIN artists a ON a.artist_name = coalesce(s.artist_name, l.artist_name)),
two_ways AS (SELECT *, CASE way WHEN 'genres' THEN score::DOUBLE ELSE distinctiveness END AS w FROM latest_genres, (SELECT unnest(['genres', 'special_genres']) AS way)),
placed AS (SELECT *, sum(w) OVER (PARTITION BY country_code, way) AS total, count(*) OVER (PARTITION BY country_code, way) AS genre_count, row_number() OVER (PARTITION BY country_code, way ORDER BY w DESC, genre) AS place FROM two_ways WHERE w > 0),
shown AS (SELECT *, round(100.0::DOUBLE * w / nullif(total, 0), 2) AS percentage FROM placed WHERE place <= 15),
left_over AS (SELECT country_code, greatest(0.0::DOUBLE, round(100 - round(sum(percentage), 6), 2)) AS p, max(genre_count) - count(*) AS n FROM shown WHERE way = 'genres' GROUP BY 1),
spread AS (SELECT *, count(*) OVER (PARTITION BY artist_name) AS reach, (SELECT count(DISTINCT country_code) FROM latest_chart) AS everywhere FROM current_streams),
rare AS (SELECT *, round(streams * ln(everywhere / reach), 1) AS gem_score FROM spread WHERE reach < everywhere),
panels AS (
  SELECT g.country_code, g.genre, g.artist_name, streams, best_position, row_number() OVER (PARTITION BY g.country_code, g.genre ORDER BY streams DESC NULLS LAST, g.artist_name) AS place
  FROM country_artist_genres g JOIN latest_genre_day l ON g.country_code = l.country_code AND g.snapshot_date = l.snapshot_date
  JOIN (SELECT DISTINCT country_code, genre FROM shown) w ON g.country_code = w.country_code AND g.genre = w.genre
  LEFT JOIN current_streams s ON g.country_code = s.country_code AND g.artist_name = s.artist_name),
detail AS (
  SELECT n_name AS country_code, 'rest' AS part, 0 AS place, NULL AS name, NULL AS detail, p::DOUBLE AS v1, n::DOUBLE AS v2, NULL::DOUBLE AS v3, NULL::DOUBLE AS v4 FROM nation LEFT JOIN left_over ON country_code = n_name
  UNION ALL SELECT country_code, 'popularity', place, artist, NULL, streams, listeners, fans, NULL FROM popular WHERE place <= 12
  UNION ALL SELECT country_code, way, place, genre, array_to_string(sources, ','), percentage, score, distinctiveness, NULL FROM shown
  UNION ALL SELECT country_code, 'hidden_gems', row_number() OVER (PARTITION BY country_code ORDER BY gem_score DESC, artist_name) AS r, artist_name, NULL, streams, best_position, reach, gem_score FROM rare QUALIFY r <= 10
  UNION ALL SELECT c.country_code, 'chart', position, artist_name, track_name, position, coalesce(daily_streams, weekly_streams, total_streams, 0), NULL, NULL
            FROM chart_entries c JOIN latest_chart l ON c.country_code = l.country_code AND c.snapshot_date = l.snapshot_date WHERE position <= 10
  UNION ALL SELECT DISTINCT country_code, 'panel:' || genre, 0, CASE WHEN length(genre) % 3 = 0 THEN 'About ' || genre || '.' END, CASE WHEN length(genre) % 3 = 0 THEN 'http://g/' || genre END, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE FROM panels
  UNION ALL SELECT country_code, 'panel:' || genre, place, artist_name, NULL, streams, best_position, NULL, NULL FROM panels WHERE place <= 5)"""


@query(DETAIL + " SELECT country_code, part, CAST(place AS BIGINT) AS place, name, detail, v1, v2, v3, v4 FROM detail")
def country_detail(spark, sf_dir):
    return market.flattened(market.country_detail(_w(spark, sf_dir)))


@query(_rescored(DETAIL) + " SELECT country_code, part, CAST(place AS BIGINT) AS place, name, detail, v1, v2, v3, v4 FROM detail")
def published_details(spark, sf_dir):
    return market.flattened(refresh.published(spark, _published(spark, sf_dir), "countries"))


ASKED = [("NATION_1", "anvil"), ("nation_2", "bolt"), ("Nation_4", "no such genre"), ("NATION_5", "ANVIL"), ("nowhere", "anvil")]


@query(
    DETAIL
    + f""" SELECT asked, c.country_code, CASE WHEN count(name) > 0 THEN string_agg(name, ',' ORDER BY place) END AS artists
FROM (SELECT unnest({[f"{c}/{g}" for c, g in ASKED]}) AS asked) a JOIN nation ON lower(n_name) = lower(split_part(asked, '/', 1)) LEFT JOIN detail d ON d.country_code = n_name AND part = 'panel:' || split_part(asked, '/', 2) AND place > 0
CROSS JOIN (SELECT n_name AS country_code FROM nation) c WHERE c.country_code = n_name GROUP BY ALL"""
)
def genre_panels(spark, sf_dir):
    """Panels asked for by codes in any case: those a country has, one it hasn't, one in capitals (genres are matched as they are), and no country."""
    details, out = market.country_detail(_w(spark, sf_dir)), None
    for code, genre in ASKED:
        names = F.array_join(F.transform("panel.artists", lambda x: x["artist"]), ",")
        row = market.genre_panel(details, code, genre).select(F.lit(f"{code}/{genre}").alias("asked"), "country_code", names.alias("artists"))
        out = row if out is None else out.unionByName(row)
    return out


# ---- raw documents


def _documents(rows: DataFrame, path: str) -> None:
    """Rows (country_code, ...) as one JSON document for each country, the other columns as its fields."""
    fields = [c for c in rows.columns if c != "country_code"]
    sinks.write_documents(rows.select(F.col("country_code").alias("name"), F.to_json(F.struct(F.col("country_code").alias("country"), *fields)).alias("document")), path)


def _in_order(rows: DataFrame, by: list[str], order: str, value, name: str) -> DataFrame:
    made = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v")))), lambda x: x["v"])
    return rows.groupBy(*by).agg(made.alias(name))


@query("""
, rows_of AS (SELECT l.country_code, l.artist_name, row_number() OVER (PARTITION BY l.country_code ORDER BY l.artist_name) - 1 AS pos, CASE WHEN (l.listeners + length(l.country_code)) % 3 <> 0 THEN 'm' || l.country_code || l.artist_name END AS mbid
  FROM country_artist_listeners l JOIN (SELECT country_code, max(snapshot_date) AS d FROM country_artist_listeners GROUP BY 1) m ON l.country_code = m.country_code AND l.snapshot_date = m.d)
SELECT artist_name, arg_min(mbid, (country_code || '.json', pos)) FILTER (mbid IS NOT NULL) AS mbid, arg_min(country_code, (country_code || '.json', pos)) FILTER (mbid IS NOT NULL) AS first_file FROM rows_of GROUP BY 1""")
def known_ids(spark, sf_dir):
    """Ids out of one listener document for each country: the first file that has one wins, and a later one fills in where earlier ones have none."""
    root = f"{testview.scratch(spark)}/listeners"
    heard = C.latest(_w(spark, sf_dir).country_artist_listeners)
    some = F.when((F.col("listeners") + F.length("country_code")) % 3 != 0, F.concat(F.lit("m"), "country_code", "artist_name")).otherwise("")
    entry = F.struct(F.col("artist_name").alias("name"), F.col("listeners").cast("string").alias("listeners"), some.alias("mbid"))
    _documents(_in_order(heard, ["country_code"], "artist_name", entry, "artists"), root)
    rows = raw.ids_in_file_order(spark, root)
    first = C.dedupe_first(rows.where("mbid is not null"), ["artist_name"], "place")
    file = F.regexp_replace(F.col("place.file"), r"\.json$", "")
    return matching.first_mbid(rows, "place").join(first.select("artist_name", file.alias("first_file")), "artist_name", "left")


@query("""
, listed AS (
  SELECT country_code, artist_name, n_nationkey % 3 <> 1 AS heard FROM current_streams JOIN nation ON n_name = country_code WHERE n_nationkey % 3 <> 1 QUALIFY row_number() OVER (PARTITION BY country_code ORDER BY best_position) <= 100
  UNION ALL SELECT country_code, artist_name, false FROM current_streams JOIN nation ON n_name = country_code WHERE n_nationkey % 3 = 1 AND best_position <= 100),
t AS (SELECT *, sum(score) OVER (PARTITION BY country_code) AS total FROM (
  SELECT k.country_code, bucket AS genre, CAST(sum(weight) AS BIGINT) AS score FROM known_tags k JOIN latest_chart l ON k.country_code = l.country_code AND k.snapshot_date = l.snapshot_date
  JOIN listed a ON k.country_code = a.country_code AND k.artist_name = a.artist_name WHERE bucket <> 'other' AND (source = 'b' OR heard) GROUP BY ALL)),
d AS (SELECT genre, count(*) AS df FROM t WHERE score::DOUBLE / total::DOUBLE >= 0.01::DOUBLE GROUP BY 1), n AS (SELECT count(DISTINCT country_code) AS n FROM t)
SELECT country_code, t.genre, score, CASE WHEN score::DOUBLE / total::DOUBLE >= 0.01::DOUBLE AND df > 0 THEN round(score * ln(n / df), 3) ELSE 0.0::DOUBLE END AS distinctiveness FROM t LEFT JOIN d ON t.genre = d.genre CROSS JOIN n""")
def cleanse_raw(spark, sf_dir):
    """The latest day written as raw documents of three kinds, one file for each country, and cleansed from there. Every
    third country has no listener document, so its chart stands in for it. As in the sources, a document lists 100 rows or artists."""
    root, w = testview.scratch(spark), _w(spark, sf_dir)
    rows = C.latest(w.chart_entries).where("position <= 100")
    text = lambda c: F.col(c).cast("string")
    cells = F.array(text("position"), F.lit("="), F.concat("artist_name", F.lit(" - "), "track_name"), F.lit("-"), F.lit("*"), F.lit(""), text("daily_streams"), F.lit("+1"), text("weekly_streams"), F.lit("-1"), text("total_streams"))
    _documents(_in_order(rows, ["country_code"], "position", cells, "rows"), f"{root}/charts")

    tags = C.latest(testview.tags(w.lines))
    ranked = C.top(C.artist_streams(w.chart_entries), ["country_code"], [F.asc("best_position")], 100)
    entry = F.struct(F.col("artist_name").alias("name"), text("streams").alias("listeners"), F.lit("").alias("mbid"))
    artists = _in_order(ranked, ["country_code"], "rank", entry, "artists")
    by_artist = _in_order(tags.where("source = 'a'"), ["country_code", "artist_name"], "pos", F.struct(F.col("tag").alias("name"), "count"), "tags")
    mapped = by_artist.groupBy("country_code").agg(F.map_from_entries(F.collect_list(F.struct("artist_name", "tags"))).alias("tags_by_artist"))
    heard = testview.tables(spark, sf_dir)("nation").where("n_nationkey % 3 <> 1").select(F.col("n_name").alias("country_code"))
    _documents(artists.join(mapped, "country_code", "left").join(heard, "country_code"), f"{root}/listeners")

    lists = _in_order(tags.where("source = 'b'"), ["country_code", "artist_name"], "pos", F.col("tag"), "genres")
    _documents(lists.groupBy("country_code").agg(F.map_from_entries(F.collect_list(F.struct("artist_name", "genres"))).alias("genres_by_artist")), f"{root}/genres")

    none = spark.createDataFrame([], "keyword string, bucket string, priority int")
    done = refresh.cleanse_folders(spark, f"{root}/charts", f"{root}/listeners", f"{root}/genres", w.countries, None, testview.noun_buckets(spark, sf_dir), none, fuzzy=False, within=f"{root}/kept")
    return done.scores.select("country_code", "genre", "score", "distinctiveness")


@query(
    """
WITH s AS (SELECT s_suppkey AS k, s_name AS name, CAST(floor(s_acctbal) AS BIGINT) AS f FROM supplier),
one AS (SELECT 1 AS round, k, name, true AS asked, CASE WHEN k % 5 = 0 THEN 'error' WHEN k % 3 = 0 THEN 'miss' ELSE 'hit' END AS status, f + 1 AS fans FROM s WHERE k % 2 = 0),
two AS (SELECT 2, k, name, k % 2 = 1 OR k % 5 = 0, CASE WHEN k % 3 = 0 THEN 'miss' ELSE 'hit' END, f + CASE WHEN k % 2 = 1 OR k % 5 = 0 THEN 2 ELSE 1 END FROM s),
three AS (SELECT 3, k, name, true, CASE WHEN k % 7 = 0 THEN 'error' WHEN k % 3 = 0 THEN 'miss' ELSE 'hit' END, f + 3 FROM s WHERE k % 4 <> 1),
four AS (SELECT 4, k, name, k % 4 = 1 OR k % 7 = 0, CASE WHEN k % 3 = 0 THEN 'miss' ELSE 'hit' END, f + CASE WHEN k % 4 = 1 OR k % 7 = 0 THEN 4 ELSE 3 END FROM s)
SELECT round, name, asked, status, CASE WHEN status = 'hit' THEN fans END AS fans FROM (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three UNION ALL SELECT * FROM four)""",
    views=False,
)
def lookup_rounds(spark, sf_dir):
    """Four rounds of look-ups against one table of results: half of the names, all of them, most under a newer rule, all under it.
    What a round answers tells its number, so an answer shows when it was found."""
    s = testview.tables(spark, sf_dir)("supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("k"), F.floor("s_acctbal").alias("f"))
    root, out = testview.scratch(spark), None
    for n, version, wanted, fails in ((1, 1, "k % 2 = 0", "k % 5 = 0"), (2, 1, "true", "false"), (3, 2, "k % 4 <> 1", "k % 7 = 0"), (4, 2, "true", "false")):

        def ask(names: DataFrame, n=n, fails=fails) -> DataFrame:
            return names.join(s, "name").select("name", F.when(F.col("k") % 3 != 0, F.col("f") + n).alias("fans"), F.expr(fails).alias("failed"))

        found = lookups.round_of(s.where(wanted).select("name"), f"{root}/results", version, "fans bigint", ask, root)
        row = found.select(F.lit(n).alias("round"), "name", "asked", "status", "fans")
        out = row if out is None else out.unionByName(row)
    return out


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
