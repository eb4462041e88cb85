"""From raw documents to packed training sequences, one operator of ``terroir.llm`` after another.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next one's docs. All but the last return the columns of ``documents``, with ``n_chars`` kept in
step with the text. ``run`` applies them to the whole table.

Defined results: a null or empty text, or one without letters, goes in the first stage; an empty table gives no rows at
any stage; rows that repeat an id are judged row by row, except that a line counts once for an id, and that of near
duplicates with one id those go that have the text of one that goes; extra columns are kept up to the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm import best_fit_packing, decontamination, language_id, line_dedup, ngram_join
from terroir.llm.common import alone, discard, table
from terroir.session import importable

#: Training, clustering and packing can't be written in SQL; tests hold every stage against plain Python.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any language go."""
    return language_id.keep_known(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that five documents share stay in one of them."""
    return _counted(line_dedup.LineIndex.build(docs).apply(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays."""
    return ngram_join.one_of_each(docs, ngram_join.Measure(words=5, num=80))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Test items are cut out of the texts; documents that are mostly test items go."""
    return _counted(decontamination.remove(docs, table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and offsets."""
    return best_fit_packing.pack(docs, best_fit_packing.vocabulary_path())


def _ready(stage):
    """The stage, run in a session whose workers find the package."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("language", _ready(known_language)),
    ("lines", _ready(repeated_lines)),
    ("near_duplicates", _ready(near_duplicates)),
    ("benchmark", _ready(benchmark_passages)),
    ("packing", _ready(packed)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before, docs = docs, alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        discard(before)  # tables of the folder itself aren't touched
    return docs
