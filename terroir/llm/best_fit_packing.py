"""Best-fit packing: documents into as few sequences of a fixed length as possible.

Only lengths matter to a packing, and there are at most ``capacity`` of them. So Spark counts the pieces of each
length, the driver plans on that histogram (at most ``capacity`` numbers, whatever the corpus), and Spark hands each
piece its place: the r-th piece of a length takes the r-th slot of that length in the plan.

The plan is best-two-fit. A sequence is filled greedily with the longest length that still fits; then its shortest
member is replaced by two unpacked lengths whose sum fits the widened gap more tightly, if there are such. The same
filling is repeated as often as the histogram allows, so the number of planning steps doesn't grow with the corpus.

Defined results: a null text is an empty one (one end-of-text token, so one piece of length 1); repeated ids and null
ids are packed row by row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import settle, slices, table

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 1024, end: int = 2) -> DataFrame:
    """One row per piece of a document's ids: where it starts, its length and the CRC-32 of its ids.

    A document longer than ``capacity`` gives a first piece that holds the remainder and then full ones. ``part``
    and ``nth`` number the pieces of one length within the task that made them; they are fixed by writing the table.
    """
    last = int(end).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text"):
            out = [[] for _ in range(7)]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = tokens.encode(text or "", vocabulary) + last
                total = len(ids) // 4
                at, n = 0, total % capacity or capacity
                for k in range(-(-total // capacity)):
                    row = (doc, k, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]), part, int(seen[n]))
                    for values, value in zip(out, row, strict=True):
                        values.append(value)
                    seen[n] += 1
                    at, n = at + n, capacity
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names=[x.split()[0] for x in PIECES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


class _Left:
    """How many pieces of each length are still unpacked, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {n: c for n, c in counts.items() if c > 0}
        self.lengths = sorted(self.counts)

    def longest(self, gap: int) -> int:
        """The longest unpacked length of at most ``gap``, or 0."""
        i = bisect.bisect_right(self.lengths, gap)
        return self.lengths[i - 1] if i else 0

    def take(self, n: int, times: int = 1) -> None:
        self.counts[n] -= times
        if not self.counts[n]:
            del self.counts[n]
            self.lengths.pop(bisect.bisect_left(self.lengths, n))

    def put(self, n: int) -> None:
        if n not in self.counts:
            bisect.insort(self.lengths, n)
        self.counts[n] = self.counts.get(n, 0) + 1

    def pair(self, gap: int, above: int) -> tuple[int, int] | None:
        """Two unpacked lengths with the largest sum in (above, gap]."""
        best, sizes, i, j = None, self.lengths, 0, len(self.lengths) - 1
        while i <= j:
            total = sizes[i] + sizes[j]
            if total > gap or (i == j and self.counts[sizes[i]] < 2):
                j -= 1
            else:
                if total > above:
                    above, best = total, (sizes[j], sizes[i])
                    if total == gap:
                        break
                i += 1
        return best


def plan(counts: dict[int, int], capacity: int = 1024) -> list[tuple[int, list[int]]]:
    """Fillings as (how many sequences, lengths in order); together they use up ``counts``."""
    left, fillings = _Left(counts), []
    while left.lengths:
        members, gap = [], capacity
        while gap and (n := left.longest(gap)):
            members.append(n)
            left.take(n)
            gap -= n
        if gap and len(members) > 1 and (two := left.pair(gap + members[-1], members[-1])):
            left.put(members.pop())
            for n in two:
                members.append(n)
                left.take(n)
        used = {n: members.count(n) for n in members}
        more = min(left.counts.get(n, 0) // k for n, k in used.items())
        for n, k in used.items() if more else ():
            left.take(n, k * more)
        fillings.append((1 + more, members))
    return fillings


def slots(fillings: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """By length, the slots in order as rows (first rank, first sequence, offset): one row for each member of a filling."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, members in fillings:
        offset = 0
        for n in members:
            rows.setdefault(n, []).append((used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        sequence += times
    return {n: np.array(v, np.int64) for n, v in rows.items()}


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end: int = 2) -> DataFrame:
    """One row per piece with the sequence it is packed in and its offset there."""
    cut = settle(pieces(docs, vocabulary, capacity, end))
    counts = settle(cut.groupBy("part", "length").agg(F.count("*").alias("n")))
    # at most `capacity` rows
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(plan(total, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("nth").to_numpy() + batch.column("base").to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for n in np.unique(length):
                rows, at = places[int(n)], length == n
                slot = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                sequence[at], offset[at] = slot[:, 1] + rank[at] - slot[:, 0], slot[:, 2]
            kept = [batch.column(x) for x in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[x.split()[0] for x in PLACED.split(", ")])

    return cut.join(base, ["part", "length"]).mapInArrow(place, PLACED)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary_path())


QUERIES = {"op1_best_fit_packing": op1_best_fit_packing}
