"""The driver's star schema seen as charts, artists, listeners and tags, in Spark and as the same DuckDB text.

Countries are customers' nations, artists are suppliers, a snapshot is a quarter. So that the latest day differs
between countries, the last quarter is left out for every third nation.
"""

from __future__ import annotations

import tempfile
import uuid
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators import charts as C
from .operators import genres as G
from .sources.raw import exists


def tables(spark: SparkSession, sf_dir: str):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share: under ``spark.checkpoint.dir``, or a temporary one where that is unset (tests)."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    named = named or tempfile.mkdtemp(prefix="terroir-")
    return f"{named.rstrip('/')}/warehouse-{uuid.uuid4().hex}"


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_custkey, country_code, snapshot_date) of every order."""
    t = tables(spark, sf_dir)
    nation = t("nation").select("n_nationkey", "n_name")
    customers = t("customer").select("c_custkey", "c_nationkey").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t("orders").select("o_orderkey", "o_custkey", F.date_trunc("quarter", "o_orderdate").cast("date").alias("snapshot_date"))
    last = orders.agg(F.max("snapshot_date").alias("last_day"))
    met = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).crossJoin(F.broadcast(last))
    met = met.where((F.col("n_nationkey") % 3 != 0) | (F.col("snapshot_date") < F.col("last_day")))
    return met.select("o_orderkey", "o_custkey", F.col("n_name").alias("country_code"), "snapshot_date")


def lines(spark: SparkSession, sf_dir: str, since: date | None = None) -> DataFrame:
    """One row per line item with its country, day, artist and part; of the days from ``since`` on, if given."""
    t = tables(spark, sf_dir)
    orders = placed(spark, sf_dir)
    if since is not None:
        orders = orders.where(F.col("snapshot_date") >= F.lit(since))
    items = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")
    suppliers = t("supplier").select("s_suppkey", F.col("s_name").alias("artist_name"))
    parts = t("part").select("p_partkey", F.col("p_name").alias("track_name"), "p_size")
    met = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return met.drop("o_orderkey", "s_suppkey", "p_partkey")


def chart_entries(rows: DataFrame) -> DataFrame:
    place = Window.partitionBy("country_code", "snapshot_date").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    return rows.select(
        "country_code",
        "snapshot_date",
        F.row_number().over(place).cast("bigint").alias("position"),
        "artist_name",
        "track_name",
        F.when(F.col("l_returnflag") != "R", F.floor("l_quantity")).alias("daily_streams"),
        F.when(F.col("l_linenumber") % 2 != 0, F.floor("l_extendedprice")).alias("weekly_streams"),
        F.when(F.col("l_linenumber") % 4 != 0, F.floor(F.col("l_extendedprice") * 10)).alias("total_streams"),
    )


def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    met = t("supplier").join(F.broadcast(t("nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    return met.select(
        F.col("s_name").alias("artist_name"),
        F.when(F.col("s_suppkey") % 5 != 0, F.col("n_name")).alias("origin_country"),
        F.when(F.col("s_acctbal") >= 0, F.floor("s_acctbal")).alias("fans"),
        F.when(F.col("s_suppkey") % 7 != 0, F.lit("2001-01-01").cast("timestamp")).alias("resolved_at"),
    )


def listeners(rows: DataFrame) -> DataFrame:
    recent = Window.partitionBy("country_code").orderBy(F.desc("snapshot_date"))
    days = rows.select("country_code", "snapshot_date").distinct().withColumn("r", F.dense_rank().over(recent)).where("r <= 2").drop("r")
    heard = rows.where("l_suppkey % 4 <> 1").join(days, ["country_code", "snapshot_date"])
    return heard.groupBy("country_code", "artist_name", "snapshot_date").agg(F.count_distinct("o_custkey").alias("listeners"))


def tags(rows: DataFrame) -> DataFrame:
    """(country_code, snapshot_date, artist_name, pos, tag, count, source): odd lines are source a, even ones source b."""
    source = F.when(F.col("l_linenumber") % 2 == 1, "a").otherwise("b")
    order = Window.partitionBy("country_code", "snapshot_date", "artist_name", "source").orderBy("l_orderkey", "l_linenumber", "track_name", "p_size")
    named = rows.withColumn("source", source).withColumn("pos", F.row_number().over(order) - 1)
    return named.select("country_code", "snapshot_date", "artist_name", "pos", F.col("track_name").alias("tag"), F.when(F.col("source") == "a", (F.col("p_size") * 2).cast("string")).alias("count"), "source")


def noun_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(bucket, priority): the nouns of the part names, in order of the alphabet; every fifth is left out, so some tags stay unclassified."""
    nouns = tables(spark, sf_dir)("part").select(F.split("p_name", " ")[1].alias("bucket")).distinct().where("bucket is not null")
    ranked = nouns.agg(F.array_sort(F.collect_list("bucket")).alias("all")).select(F.posexplode("all").alias("priority", "bucket"))
    return ranked.where("priority % 5 <> 4")


def known_tags(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """(country_code, snapshot_date, artist_name, source, bucket, weight): the classified tags of every country and day.

    Every tag is a part's name, so the parts give the values to classify, and the rows are shuffled for their places alone.
    """
    none = spark.createDataFrame([], "keyword string, bucket string, priority int")
    values = tables(spark, sf_dir)("part").select(F.col("p_name").alias("tag"))
    known = G.classified(tags(rows), None, noun_buckets(spark, sf_dir), none, fuzzy=False, values=values)
    return known.select("country_code", "snapshot_date", "artist_name", "source", "bucket", "weight")


def genre_scores(known: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scores and artists of every country and day, and the classified tags they come from."""
    keys = ["country_code", "snapshot_date"]
    per_day = G.vote(known, keys)
    total = F.sum("score").over(Window.partitionBy(*keys))
    shared = per_day.withColumn("total", total)
    df = shared.where(F.col("score") / F.col("total") >= 0.01).groupBy("snapshot_date", "genre").agg(F.count("*").alias("df"))
    n = per_day.groupBy("snapshot_date").agg(F.count_distinct("country_code").alias("n"))
    met = shared.join(df, ["snapshot_date", "genre"], "left").join(n, "snapshot_date")
    good = (F.col("score") / F.col("total") >= 0.01) & (F.col("df") > 0)
    scores = met.select(*keys, "genre", "score", "sources", F.when(good, F.round(F.col("score") * F.ln(F.col("n") / F.col("df")), 3)).otherwise(F.lit(0.0)).alias("distinctiveness"))
    return scores, G.behind(known, keys), known


class View:
    """The warehouse tables made from the star schema. As in a warehouse, a table is written once and then read: the
    first query that uses it makes it, later ones of the session read its files.

    All lines are never written: tables are made from the join, and hold less than it. With ``recent`` all tables leave
    out days before the last but one of the country whose days end first, which no latest figure needs; only those days'
    orders meet the line items, and their lines are a table of their own.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, recent: bool):
        self.spark, self.sf_dir, self.recent = spark, sf_dir, recent
        self.paths: list[str] = []
        self.made: dict[str, object] = {}

    def once(self, name: str, make):
        """What ``make`` gave when it was first asked for under this name."""
        if name not in self.made:
            self.made[name] = make()
        return self.made[name]

    def _written(self, df: DataFrame) -> DataFrame:
        path = scratch(self.spark)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def lines(self) -> DataFrame:
        return self._recent() if self.recent else lines(self.spark, self.sf_dir)

    def _recent(self, depth: int = 2) -> DataFrame:
        """The lines from the last but one day with lines of the country whose days end first.

        Days are first those of the orders. A country with fewer than two days among the lines made, which may have older
        ones, has orders without lines: then twice as many days are taken.
        """
        ordered = self._written(C.recency(placed(self.spark, self.sf_dir)))
        while True:
            since = ordered.where(F.col("recency") <= depth).agg(F.min("snapshot_date")).first()[0]
            made = self._written(lines(self.spark, self.sf_dir, since))
            found = C.recency(made).where("recency <= 2")
            whole = found.where("recency = 2").select("country_code")
            older = ordered.where(F.col("snapshot_date") < F.lit(since)) if since is not None else ordered
            if older.join(whole, "country_code", "left_anti").isEmpty():
                first = found.agg(F.min("snapshot_date")).first()[0]
                return made.where(F.col("snapshot_date") >= F.lit(first))
            depth *= 2

    @cached_property
    def scored(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return genre_scores(self._written(known_tags(self.spark, self.sf_dir, self.lines)))

    @cached_property
    def _ranked(self) -> DataFrame:
        top = self.chart_entries.groupBy("country_code", "snapshot_date", "artist_name").agg(F.min("position").alias("p"))
        return top.withColumn("rank", F.row_number().over(Window.partitionBy("country_code", "snapshot_date").orderBy("p")).cast("bigint")).drop("p")

    @cached_property
    def chart_entries(self) -> DataFrame:
        return self._written(chart_entries(self.lines))

    @cached_property
    def artists(self) -> DataFrame:
        return artists(self.spark, self.sf_dir)

    @cached_property
    def country_artist_listeners(self) -> DataFrame:
        """Of each country's last two days alone, so the recent lines hold all of it."""
        return self._written(listeners(self.lines)) if self.recent else warehouse(self.spark, self.sf_dir, recent=True).country_artist_listeners

    @cached_property
    def country_genre_scores(self) -> DataFrame:
        return self._written(self.scored[0])

    @cached_property
    def country_artist_genres(self) -> DataFrame:
        return self._written(self.scored[1])

    @cached_property
    def countries(self) -> DataFrame:
        return tables(self.spark, self.sf_dir)("nation").select(F.col("n_name").alias("code"), F.initcap("n_name").alias("name"))

    @cached_property
    def genres(self) -> DataFrame:
        """Descriptions of the genres whose names have 3, 6, ... letters."""
        told = noun_buckets(self.spark, self.sf_dir).where(F.length("bucket") % 3 == 0)
        return told.select(F.col("bucket").alias("genre"), F.concat(F.lit("About "), "bucket", F.lit(".")).alias("summary"), F.concat(F.lit("http://g/"), "bucket").alias("url"))

    @cached_property
    def country_snapshots(self) -> DataFrame:
        return self._ranked.groupBy("country_code", "snapshot_date").agg(F.count("*").alias("artist_count"))

    @cached_property
    def country_top_artists(self) -> DataFrame:
        return self._ranked.where("rank <= 100")


_VIEWS: dict[tuple[str, str, bool], View] = {}


def warehouse(spark: SparkSession, sf_dir: str, recent: bool = False) -> View:
    """The session's view of a folder; made anew if its files are gone. The folder's tables are taken not to change."""
    key = (spark.sparkContext.applicationId, sf_dir, recent)
    if key not in _VIEWS or not all(exists(spark, path) for path in _VIEWS[key].paths):
        _VIEWS[key] = View(spark, sf_dir, recent)
    return _VIEWS[key]


#: The same views as common table expressions.
VIEWS = """
lines AS (
  SELECT n.n_name AS country_code, CAST(date_trunc('quarter', o.o_orderdate) AS DATE) AS snapshot_date, s.s_name AS artist_name, p.p_name AS track_name, p.p_size,
         l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_returnflag, o.o_custkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
  WHERE n.n_nationkey % 3 <> 0 OR CAST(date_trunc('quarter', o.o_orderdate) AS DATE) < (SELECT CAST(max(date_trunc('quarter', o_orderdate)) AS DATE) FROM orders)),
chart_entries AS (
  SELECT country_code, snapshot_date, row_number() OVER (PARTITION BY country_code, snapshot_date ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS position, artist_name, track_name,
         CASE WHEN l_returnflag <> 'R' THEN CAST(floor(l_quantity) AS BIGINT) END AS daily_streams,
         CASE WHEN l_linenumber % 2 <> 0 THEN CAST(floor(l_extendedprice) AS BIGINT) END AS weekly_streams,
         CASE WHEN l_linenumber % 4 <> 0 THEN CAST(floor(l_extendedprice * 10) AS BIGINT) END AS total_streams
  FROM lines),
artists AS (
  SELECT s_name AS artist_name, CASE WHEN s_suppkey % 5 <> 0 THEN n_name END AS origin_country, CASE WHEN s_acctbal >= 0 THEN CAST(floor(s_acctbal) AS BIGINT) END AS fans,
         CASE WHEN s_suppkey % 7 <> 0 THEN TIMESTAMP '2001-01-01' END AS resolved_at
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
recent_days AS (SELECT country_code, snapshot_date, dense_rank() OVER (PARTITION BY country_code ORDER BY snapshot_date DESC) AS recency FROM (SELECT DISTINCT country_code, snapshot_date FROM lines)),
country_artist_listeners AS (
  SELECT l.country_code, artist_name, l.snapshot_date, count(DISTINCT o_custkey) AS listeners FROM lines l JOIN recent_days d ON l.country_code = d.country_code AND l.snapshot_date = d.snapshot_date
  WHERE recency <= 2 AND l_suppkey % 4 <> 1 GROUP BY ALL),
latest_chart AS (SELECT country_code, max(snapshot_date) AS snapshot_date FROM chart_entries GROUP BY 1),
current_streams AS (
  SELECT c.country_code, artist_name, CAST(sum(coalesce(daily_streams, weekly_streams, total_streams, 0)) AS BIGINT) AS streams, min(position) AS best_position
  FROM chart_entries c JOIN latest_chart l ON c.country_code = l.country_code AND c.snapshot_date = l.snapshot_date GROUP BY ALL),
raw_tags AS (
  SELECT country_code, snapshot_date, artist_name, CASE WHEN l_linenumber % 2 = 1 THEN 'a' ELSE 'b' END AS source, track_name AS tag, CASE WHEN l_linenumber % 2 = 1 THEN p_size * 2 END AS n,
         row_number() OVER (PARTITION BY country_code, snapshot_date, artist_name, l_linenumber % 2 ORDER BY l_orderkey, l_linenumber, track_name, p_size) - 1 AS pos
  FROM lines),
buckets AS (SELECT bucket, priority FROM (SELECT bucket, row_number() OVER (ORDER BY bucket) - 1 AS priority FROM (SELECT DISTINCT string_split(p_name, ' ')[2] AS bucket FROM part) WHERE bucket IS NOT NULL) WHERE priority % 5 <> 4),
tag_bucket AS (
  SELECT tag, arg_min(bucket, (CASE WHEN lower(tag) = bucket THEN 0 ELSE 1 END, -length(bucket), priority)) AS bucket FROM (SELECT DISTINCT tag FROM raw_tags) JOIN buckets ON contains(lower(tag), bucket) GROUP BY tag),
known_tags AS (
  SELECT r.*, coalesce(b.bucket, 'other') AS bucket, CAST(greatest(floor(coalesce(n, 20) / 20), 1) AS BIGINT) AS weight FROM raw_tags r LEFT JOIN tag_bucket b ON r.tag = b.tag WHERE pos < 5),
votes AS (SELECT country_code, snapshot_date, bucket AS genre, CAST(sum(weight) AS BIGINT) AS score, list_sort(list(DISTINCT source)) AS sources FROM known_tags WHERE bucket <> 'other' GROUP BY ALL),
country_artist_genres AS (SELECT DISTINCT country_code, snapshot_date, bucket AS genre, artist_name FROM known_tags WHERE bucket <> 'other'),
shared AS (SELECT *, sum(score) OVER (PARTITION BY country_code, snapshot_date) AS total FROM votes),
frequency AS (SELECT snapshot_date, genre, count(*) AS df FROM shared WHERE score::DOUBLE / total::DOUBLE >= 0.01::DOUBLE GROUP BY ALL),
contributing AS (SELECT snapshot_date, count(DISTINCT country_code) AS n FROM votes GROUP BY ALL),
country_genre_scores AS (
  SELECT s.country_code, s.snapshot_date, s.genre, s.score, s.sources, CASE WHEN s.score::DOUBLE / total::DOUBLE >= 0.01::DOUBLE AND df > 0 THEN round(s.score * ln(n / df), 3) ELSE 0.0::DOUBLE END AS distinctiveness
  FROM shared s LEFT JOIN frequency f ON s.snapshot_date = f.snapshot_date AND s.genre = f.genre JOIN contributing c ON s.snapshot_date = c.snapshot_date),
latest_genre_day AS (SELECT country_code, max(snapshot_date) AS snapshot_date FROM country_genre_scores GROUP BY 1),
latest_genres AS (SELECT g.* FROM country_genre_scores g JOIN latest_genre_day l ON g.country_code = l.country_code AND g.snapshot_date = l.snapshot_date)
"""
