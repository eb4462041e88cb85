"""Writing: idempotent tables, day replacement, column-scoped merges, raw documents, nested JSON, and counters of a run.

A folder is swapped in by two renames. A reader that opens it between them finds nothing there and has to try again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES
from .raw import exists


def create_tables(spark: SparkSession, database: str) -> None:
    """All warehouse tables; facts are partitioned by day. Running it again changes nothing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, (schema, _, daily) in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        partition = " PARTITIONED BY (snapshot_date)" if daily else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet{partition}")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Exactly the table's columns, in its order and types; a missing nullable column is null."""
    schema = TABLES[table][0]
    lost = [f.name for f in schema if f.name not in df.columns and not f.nullable]
    if lost:
        raise ValueError(f"{table} needs {', '.join(lost)}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


class Counters:
    """What a run writes, counted while it is written: no job of its own, and nothing is read again.

    ``over`` puts counts on a frame; once the frame's first action is done they are in ``found``, a dict of numbers for
    each name. A frame that turns out empty has zeros.
    """

    def __init__(self):
        self._watched: dict[str, tuple[Observation, list[str]]] = {}

    def over(self, name: str, df: DataFrame, /, **counts: Column) -> DataFrame:
        """``df``, whose rows, and rows for which each of ``counts`` is true, are counted under ``name``."""
        watch = Observation(f"{name}-{uuid.uuid4().hex}")
        self._watched[name] = (watch, ["rows", *counts])
        return df.observe(watch, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])

    @property
    def found(self) -> dict[str, dict[str, int]]:
        return {name: {c: watch.get.get(c) or 0 for c in columns} for name, (watch, columns) in self._watched.items()}


def replace_day(df: DataFrame, path: str, table: str, day: str, counters: Counters | None = None) -> None:
    """Replace one day of a fact under ``path``; an empty frame empties the day. Other days aren't touched.

    The day is written beside the table first and then swapped in, so a frame may read the day it replaces.
    """
    spark = df.sparkSession
    rows = conform(df.withColumn("snapshot_date", F.lit(day).cast("date")), table).drop("snapshot_date")
    rows = counters.over(table, rows) if counters else rows
    key = [c for c in TABLES[table][1] if c != "snapshot_date"]
    fresh, at = f"{path}/.day-{uuid.uuid4().hex}", f"{path}/snapshot_date={day}"
    rows.repartition(*key[:1]).sortWithinPartitions(*key).write.parquet(fresh)
    _swap(spark, fresh, at)


def _swap(spark: SparkSession, fresh: str, at: str) -> None:
    """Put ``fresh`` in the place of ``at``. The old files are only moved aside until then, so a crash loses nothing."""
    Path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    files = Path(at).getFileSystem(conf)
    folder, name = at.rstrip("/").rsplit("/", 1)
    aside = f"{folder}/.old-{name}-{uuid.uuid4().hex}"
    had = files.exists(Path(at))
    if had and not files.rename(Path(at), Path(aside)):
        raise OSError(f"can't move {at} aside")
    if not files.rename(Path(fresh), Path(at)):
        if had:
            files.rename(Path(aside), Path(at))
        raise OSError(f"can't move {fresh} to {at}")
    if had:
        files.delete(Path(aside), True)


def swap_in(df: DataFrame, path: str) -> None:
    """Write ``df`` beside ``path`` and swap it in; ``df`` may read what it replaces."""
    fresh = f"{path}.next-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    _swap(df.sparkSession, fresh, path)


def kept(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written to a new table under ``folder`` and read back, so that it is worked out once."""
    path = f"{folder}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str, table: str) -> None:
    conform(df, table).write.mode("append").partitionBy(*(["snapshot_date"] if TABLES[table][2] else [])).parquet(path)


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table's rows; none where it was never written."""
    schema = TABLES[table][0]
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def merged(old: DataFrame, new: DataFrame, key: str, update: list[str] | None = None) -> DataFrame:
    """``old`` with the new keys added; on a match only the ``update`` columns are taken from ``new`` (none: insert only).

    A key that ``new`` has twice raises when the result is computed.
    """
    owned = set(update or [])
    single = new.groupBy(key).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in new.columns if c != key])
    checked = single.withColumn(key, F.when(F.col("n") == 1, F.col(key)).otherwise(F.raise_error(F.concat(F.lit("repeated key "), F.col(key).cast("string"))).cast("string"))).drop("n")
    a, b = old.withColumn("in_old", F.lit(True)).alias("a"), checked.withColumn("in_new", F.lit(True)).alias("b")
    met = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")

    def column(name: str):
        ours = F.col(f"a.{name}")
        if name == key:
            return F.coalesce(ours, F.col(f"b.{name}"))
        theirs = F.col(f"b.{name}") if name in new.columns else F.lit(None).cast(old.schema[name].dataType)
        return F.when(F.col("in_old").isNull() | (F.lit(name in owned) & F.col("in_new").isNotNull()), theirs).otherwise(ours)

    return met.select(*[column(c).alias(c) for c in old.columns])


def merge_dimension(new: DataFrame, path: str, table: str, update: list[str] | None = None, counters: Counters | None = None) -> None:
    """Upsert into a dimension under ``path``: written as a whole beside it, then swapped in. Counts rows, and those with each updated column."""
    result = conform(merged(read_table(new.sparkSession, path, table), new, TABLES[table][1][0], update), table)
    swap_in(counters.over(table, result, **{c: F.col(c).isNotNull() for c in update or []}) if counters else result, path)


def store_day(parts: dict[str, DataFrame], path: str, day: str) -> None:
    """The named parts of one day as JSON beside other days. All parts are swapped in at once: there is never a report
    without the day it is about, nor a day without its report. Storing a day again replaces it."""
    fresh = f"{path}/.day-{uuid.uuid4().hex}"
    for name, rows in parts.items():
        rows.write.json(f"{fresh}/{name}")
    _swap(next(iter(parts.values())).sparkSession, fresh, f"{path}/snapshot_date={day}")


def stored(spark: SparkSession, path: str, name: str, schema) -> DataFrame:
    """One part of all stored days with their ``snapshot_date``; no rows where nothing was stored yet."""
    days = f"{path}/snapshot_date=*/{name}"
    if not exists(spark, path):
        return spark.createDataFrame([], schema).withColumn("snapshot_date", F.lit(None).cast("date"))
    return spark.read.schema(schema).option("basePath", path).json(days).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


def write_documents(df: DataFrame, path: str, suffix: str = ".json") -> None:
    """One text file for each row of ``df`` (name, document), named after it, as raw documents come. Documents are as many as
    countries, so the driver renames them one by one."""
    spark = df.sparkSession
    fresh = f"{path}.next-{uuid.uuid4().hex}"
    df.select("name", F.col("document").alias("value")).repartition("name").write.partitionBy("name").text(fresh)
    Path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    files = Path(fresh).getFileSystem(conf)
    for found in files.globStatus(Path(f"{fresh}/name=*/part-*")):
        at = found.getPath()
        name = at.getParent().getName().removeprefix("name=")
        if not files.rename(at, Path(f"{fresh}/{name}{suffix}")):
            raise OSError(f"can't rename {at}")
        files.delete(at.getParent(), True)
    _swap(spark, fresh, path)


def publish_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """Nested rows as JSON, one folder for each value of ``by``. One job for all countries."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)
