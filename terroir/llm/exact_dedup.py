"""Exact dedup with counting quotient filters.

Each task builds a counting quotient filter of the 64-bit fingerprints of its texts: the quotient (high bits) names a
block, the remainders of a block are kept sorted with their counts. Filters merge without loss, block by block, by
merging sorted remainders and adding counts; Spark shuffles the blocks, so no task sees the whole filter. A
fingerprint counted once is certainly unique. Those counted more often go to byte verification: their rows are grouped
by the normalised text itself.

Defined results: null counts as empty; of equal texts the smallest id stays, null ids last; rows that repeat both id
and text share their verdict (all of them are kept if the id is the one to stay); an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, slices, small, table, text_bytes

SPACE = b" \t\n\x0b\x0c\r"
#: Fingerprints that a block of a merged filter holds on average, and the fewest bits of a quotient.
BLOCK_ROWS, LEAST_BITS = 1 << 16, 10
#: Bytes of repeated fingerprints that may be broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20


def normalised(text: bytes | None) -> bytes:
    """Each run of ASCII white space as one space."""
    if not text:
        return b""
    middle = b" ".join(text.split())
    if not middle:
        return b" "
    return (b" " if text[0] in SPACE else b"") + middle + (b" " if text[-1] in SPACE else b"")


def _fingerprint(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and SHA-256 of the normalised text, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [normalised(x) for x in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_signed([_fingerprint(x) for x in texts])), pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string())],
                names=["doc_id", "fp", "text_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long, text_sha256 string")


def quotient_bits(rows: int) -> int:
    """High bits of a fingerprint that name its block, so that blocks stay as small however large the corpus is."""
    return max(LEAST_BITS, (rows // BLOCK_ROWS).bit_length())


def _runs(fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Blocks of a counting quotient filter: (quotient, sorted remainders, their counts). Equal fingerprints are added up."""
    order = np.argsort(fingerprints, kind="stable")
    sorted_fps, sorted_counts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.r_[True, sorted_fps[1:] != sorted_fps[:-1]])
    fps, totals = sorted_fps[first], np.add.reduceat(sorted_counts, first)
    quotients = (fps >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1], True])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(quotients[a]), (fps[a:b] << np.uint64(bits)).tobytes(), totals[a:b].tobytes()


BLOCK = "quotient long, remainders binary, counts binary"


def _blocks(runs: Iterator[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    rows = list(runs)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["quotient", "remainders", "counts"])


def partition_filters(fingerprints: DataFrame, bits: int, most: int = 1 << 20) -> DataFrame:
    """A counting quotient filter per task (and per ``most`` rows of it), as blocks."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column("fp").to_numpy().view(np.uint64))
            n += batch.num_rows
            if n >= most:
                yield _blocks(_runs(np.concatenate(held), np.ones(n, np.int64), bits))
                held, n = [], 0
        if n:
            yield _blocks(_runs(np.concatenate(held), np.ones(n, np.int64), bits))

    return fingerprints.select("fp").mapInArrow(build, BLOCK)


def _unpacked(quotients: list[int], remainders: list[bytes], counts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    fps = [(np.uint64(q) << np.uint64(64 - bits)) | (np.frombuffer(r, np.uint64) >> np.uint64(bits)) for q, r in zip(quotients, remainders, strict=True)]
    return np.concatenate(fps), np.concatenate([np.frombuffer(c, np.int64) for c in counts])


def merged(filters: DataFrame, bits: int) -> DataFrame:
    """One block per quotient: sorted remainders merged, counts added. Nothing is lost, so merges can be nested."""

    def merge(block: pa.Table) -> pa.Table:
        found = _unpacked(*(block.column(x).to_pylist() for x in ("quotient", "remainders", "counts")), bits)
        return pa.Table.from_batches([_blocks(_runs(*found, bits))])

    return filters.groupBy("quotient").applyInArrow(merge, BLOCK)


def repeated(filters: DataFrame, bits: int) -> DataFrame:
    """Fingerprints (signed) counted more than once in merged filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("quotient", "remainders", "counts")), strict=True):
                fps, counts = _unpacked(*([x] for x in row), bits)
                yield pa.RecordBatch.from_arrays([pa.array(fps[counts > 1].view(np.int64))], names=["fp"])

    return filters.mapInArrow(run, "fp long")


def with_text(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, SHA-256 and the normalised text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [normalised(x) for x in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_signed([_fingerprint(x) for x in texts])), pa.array(texts, pa.binary())], names=["doc_id", "fp", "bytes"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long, bytes binary")


def dedup(docs: DataFrame) -> DataFrame:
    """Every row with the id of the one that stays among the rows of equal normalised text, and the group's size."""
    every = settle(digests(docs))
    bits = quotient_bits(every.count())
    again = settle(repeated(merged(partition_filters(every, bits), bits), bits))
    # byte verification: the text itself is the key, so copies shrink to one row per task before the shuffle
    suspects = with_text(docs).join(small(again, 16, BROADCAST_BYTES), "fp", "left_semi")
    groups = settle(
        suspects.groupBy("bytes")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("bytes", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    if groups.groupBy("text_sha256").count().where("count > 1").limit(1).count():
        raise ValueError("two different texts share a SHA-256")
    return every.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op8_exact_dedup": op8_exact_dedup}
ORACLE_SQL = {
    "op8_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
             g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
        SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM t JOIN g USING (norm)"""
}
