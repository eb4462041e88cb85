"""A kept table of look-up results, so that what is known isn't asked again.

An entry holds the md5 of the name as its key, the name, the version of the rule that chose the answer, and the answer
(null columns where the look-up found nothing). Entries of another rule version count as absent until they are replaced.
Look-ups that failed are never entered, so the next round asks again; a look-up that found nothing is entered.

Null names are never asked. Names that repeat are asked once. An answer that comes twice for one name raises, and so
does one for a name that wasn't asked, as neither can be told from a wrong answer.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import raw, sinks

KEY = ["name_key", "name", "rule_version"]


def keyed(names: DataFrame) -> DataFrame:
    """``names`` (name, ...) without null names, with the key in front."""
    rest = [c for c in names.columns if c != "name"]
    return names.where("name is not null").select(F.md5(F.col("name")).alias("name_key"), "name", *rest)


def entries(spark: SparkSession, path: str, answer: str) -> DataFrame:
    """The table under ``path``; no rows where nothing was entered yet. ``answer`` is the DDL of the answer's columns."""
    schema = f"name_key string, name string, rule_version int, {answer}"
    return spark.read.schema(schema).parquet(path) if raw.exists(spark, path) else spark.createDataFrame([], schema)


def unanswered(wanted: DataFrame, table: DataFrame, version: int) -> DataFrame:
    """(name_key, name): distinct wanted names that no entry of this rule version answers."""
    known = table.where(F.col("rule_version") == version).select("name_key")
    return keyed(wanted.select("name").distinct()).join(known, "name_key", "left_anti")


def enter(answers: DataFrame, table: DataFrame, path: str, version: int) -> None:
    """Upsert ``answers`` (name, the answer's columns, failed): those that didn't fail replace what the key has. Written beside, then swapped in."""
    columns = [c for c in table.columns if c not in KEY]
    good = keyed(answers.where(~F.coalesce("failed", F.lit(False)))).select("name_key", "name", F.lit(version).alias("rule_version"), *columns)
    sinks.swap_in(sinks.merged(table, good, "name_key", ["rule_version", *columns]), path)


def round_of(wanted: DataFrame, path: str, version: int, answer: str, ask: Callable[[DataFrame], DataFrame], within: str) -> DataFrame:
    """One round over ``wanted`` (name): asks what isn't known, enters the answers, and gives every wanted name its answer.

    ``ask`` turns (name_key, name) into (name, the answer's columns, failed). Its result is written to the folder ``within`` before
    anything is entered, so a look-up is made once even if a task is repeated later. The result has (name, the answer's
    columns, asked, status): hit, miss (looked up, nothing there) or error (never answered under this version).
    """
    spark = wanted.sparkSession
    columns = [c.split()[0] for c in answer.split(",")]
    asked = sinks.kept(unanswered(wanted, entries(spark, path, answer), version), within)
    answers = sinks.kept(ask(asked).select("name", *columns, "failed"), within)
    stray = answers.join(asked, "name", "left_anti").limit(1).collect()
    if stray:
        raise ValueError(f"an answer for {stray[0].name}, which wasn't asked")
    enter(answers, entries(spark, path, answer), path, version)
    table = entries(spark, path, answer).where(F.col("rule_version") == version)
    found = keyed(wanted.select("name").distinct()).join(table.drop("name"), "name_key", "left")
    marked = found.join(asked.select("name_key", F.lit(True).alias("was_asked")), "name_key", "left")
    something = reduce(Column.__or__, [F.col(c).isNotNull() for c in columns])
    status = F.when(F.col("rule_version").isNull(), "error").when(something, "hit").otherwise("miss")
    return sinks.kept(marked.select("name", *columns, F.coalesce("was_asked", F.lit(False)).alias("asked"), status.alias("status")), within)
