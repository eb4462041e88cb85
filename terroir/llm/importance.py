"""Importance resampling: draw the documents whose words look most like those of a target collection.

A 256-byte table lower-cases A-Z and blanks what isn't part of a word, right in the UTF-8 bytes, and ``bytes.split``
yields the words. The hash of a word is its ``zlib.crc32``; the hash of a run of words takes the hash of the run one word
shorter as its seed, so no run is ever put together. Counters reduce the hashes of a task to bucket counts. The
gains of all buckets (their number is a parameter, 10,000 here) are the only thing that tasks are told; a second pass
over the texts adds them up. Every document then draws a Gumbel number from a hash of its id, and the highest sums of
weight and number win: a draw without replacement in proportion to the weights.

Scores are whole numbers, so a histogram of them finds the score above which a document is drawn. Only the
documents from there on are sorted, by ranges, and ranked from the sizes of the ranges before theirs.

Defined results: null and empty texts have no words: no features, weight 0, never drawn unless ``least_words`` is 0.
A repeated id is judged row by row; such rows have the same random number, and at equal scores the one with more
features is drawn first. A null id is hashed as the empty string and comes last among equals. An empty target or empty
documents count as zero features everywhere. Texts of any length are taken whole. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, slices, table, text_bytes

#: Distinct hashes that a task's Counter holds before they are added to the buckets.
COUNTER_ROWS = 1 << 18
#: Rows of one id are spread over so many sort keys, so that no range gathers them.
SPREAD = 4096

#: Lower-cases A-Z; keeps digits, letters and every byte of a non-ASCII character; all else becomes a space.
_TABLE = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


@dataclass(frozen=True)
class Sampling:
    """``words``: longest run that is a feature; ``percent`` of the documents with ``least_words`` are drawn."""

    words: int = 1
    buckets: int = 10_000
    seed: int = 2024
    percent: int = 10
    least_words: int = 20


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def hashes(words: list[bytes], longest: int) -> Iterator[int]:
    """The crc32 of every run of 1 to ``longest`` words joined by one space."""
    runs = list(map(crc32, words))
    yield from runs
    spaced = [b" " + w for w in words]
    for n in range(1, longest):
        runs = list(map(crc32, spaced[n:], runs))  # a run's hash seeds that of the run one word longer
        yield from runs


def bucket_counts(texts: DataFrame, how: Sampling = Sampling()) -> np.ndarray:
    """How often each bucket is hit by the features of all texts; every task hands on one row for each bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(how.buckets, np.int64), Counter()

        def fold() -> None:
            at = np.fromiter(held.keys(), np.int64, len(held)) % how.buckets
            np.add.at(total, at, np.fromiter(held.values(), np.int64, len(held)))
            held.clear()

        for batch in slices(batches, "text"):
            for text in text_bytes(batch):
                held.update(hashes(words_of(text), how.words))
                if len(held) > COUNTER_ROWS:
                    fold()
        fold()
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    out = np.zeros(how.buckets, np.int64)
    for row in texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the log of how much likelier a bucket is in the target, one added to each count, rounded down."""
    width, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + width) / ((s + 1) * (t_all + width)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def luck(doc_id: int | None, seed: int) -> int:
    """Thousand times a standard Gumbel number, rounded down, from a hash of the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, how: Sampling = Sampling()) -> DataFrame:
    """(doc_id, n_features, weight, score, n_words, spread) of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in slices(batches, "text"):
            ids, features, weights, counts = batch.column("doc_id").to_pylist(), [], [], []
            for text in text_bytes(batch):
                words = words_of(text)
                at = np.fromiter(hashes(words, how.words), np.int64) % how.buckets
                counts.append(len(words))
                features.append(len(at))
                weights.append(int(gain[at].sum()) // len(at) if len(at) else 0)
            scores = [w + luck(i, how.seed) for w, i in zip(weights, ids, strict=True)]
            spread = (np.arange(len(ids)) + seen) % SPREAD
            seen += len(ids)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (features, weights, scores, counts, spread))], names=["doc_id", "n_features", "weight", "score", "n_words", "spread"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, n_features long, weight long, score long, n_words long, spread long")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` sorted by ranges, with the range's number and each row's place in it, written."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = np.arange(seen, seen + batch.num_rows)
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, np.int64)), pa.array(places)], names=[*batch.schema.names, "part", "place"])

    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), F.asc("spread")]
    names = ", ".join(f"{c} long" for c in rows.columns)
    return settle(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, f"{names}, part long, place long"))


def drawn(rows: DataFrame, how: Sampling = Sampling()) -> DataFrame:
    """``scored`` with ``rank``: 1 for the first document drawn, null for the others. ``rows`` is a settled table."""
    able = F.col("n_words") >= how.least_words
    # scores are sums of two bounded logarithms in thousandths: some ten thousand different ones at most, at any size
    histogram = sorted(((r.score, r["count"]) for r in rows.where(able).groupBy("score").count().collect()), reverse=True)
    most = how.percent * sum(n for _, n in histogram) // 100
    held, cut = 0, math.inf
    for score, n in histogram:
        if held >= most:
            break
        held, cut = held + n, score
    if not most:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    top = _numbered(rows.where(able & (F.col("score") >= cut)))
    ends = sorted((r.part, r.n) for r in top.groupBy("part").agg(F.count("*").alias("n")).collect())
    before = np.cumsum([0, *(n for _, n in ends)]).tolist()
    offsets = rows.sparkSession.createDataFrame([(part, start) for (part, _), start in zip(ends, before, strict=False)], "part long, start long")
    place = F.col("start") + F.col("place") + 1
    ranked = top.join(F.broadcast(offsets), "part").select(*rows.columns, F.when(place <= most, place).alias("rank"))
    return ranked.unionByName(rows.where(~able | (F.col("score") < cut)).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, how: Sampling = Sampling()) -> DataFrame:
    """Per document (doc_id, n_features, weight, score, rank); documents with a rank are the sample."""
    gain = gains(bucket_counts(docs, how), bucket_counts(target, how))
    return drawn(settle(scored(docs, gain, how)), how).select("doc_id", "n_features", "weight", "score", "rank")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_NIBBLE = "strpos('0123456789ABCDEF', substr(h, {}, 1)) - 1"

QUERIES = {"op11_importance_resampling": op11_importance_resampling}
ORACLE_SQL = {
    "op11_importance_resampling": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents), b AS (SELECT {_WORDS} AS ws FROM benchmark),
             dw AS (SELECT doc_id, unnest(ws) AS w FROM d), bw AS (SELECT unnest(ws) AS w FROM b),
             crc_table AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
             vocabulary AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
             hashed AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: ({_NIBBLE.format("2 * i + 1")}) * 16 + {_NIBBLE.format("2 * i + 2")})),
                                      lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) % 10000 AS bucket FROM vocabulary, crc_table),
             s AS (SELECT bucket, count(*) AS n FROM dw JOIN hashed USING (w) GROUP BY 1), t AS (SELECT bucket, count(*) AS n FROM bw JOIN hashed USING (w) GROUP BY 1),
             sums AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE AS s_all, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE AS t_all),
             gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000) / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + 10000)))) AS BIGINT) AS g
                      FROM (SELECT unnest(range(10000)) AS bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
             weighed AS (SELECT doc_id, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS weight FROM dw JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY 1),
             lucky AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM d),
             scores AS (SELECT l.doc_id, n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296::DOUBLE))) AS BIGINT) AS score FROM lucky l LEFT JOIN weighed w ON l.doc_id = w.doc_id),
             places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
        SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scores s LEFT JOIN places p ON s.doc_id = p.doc_id"""
}
