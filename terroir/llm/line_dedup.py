"""Reversible line dedup: sharded cuckoo filters backed by exact reference-count tables.

The exact table holds one row for each line key and document (``postings``) and from it one row for each key with its
number of documents and the largest id (``references``). Keys that enough documents hold are entered in cuckoo
filters, one small filter for each shard of the key space, made and updated by the task that owns the shard. A cuckoo
filter forgets a key on request, so documents can be inserted and deleted and the table and filters stay equal to a
rebuild. Filters save shuffling: tasks that read the postings hold the filters, of about 2.4 bytes for each repeated key,
and hand on to the exact join only the few postings that may be repeated. Filters of more than ``FILTER_BYTES`` aren't
sent to all tasks; then postings and filters are joined by shard, so a task holds one filter and about ``SHARD_POSTINGS``
postings. A line of very many documents doesn't pass there: it is known by its exact count and goes straight to the join.

An insertion or deletion counts again only the keys of the documents concerned, and writes no posting that was there
before: new postings are a further part of the table, deleted ids are left out when it is read. After ``PARTS`` changes
the table is written as one again, and the filters are dealt to more shards if it has outgrown them.

Defined results: a null or empty text is one empty line; rows that repeat an id count as one document, and each of them
loses the lines that this document loses; rows with a null id can't be told apart, count as no document and keep all
their lines; an empty table gives no rows; extra columns, whatever their names, are kept by ``apply``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle, slices, small, table, text_bytes

SPACE = b" \t\n\x0b\x0c\r"
#: Postings of one shard on average. Keys of more documents than ``HOT`` aren't filtered.
SHARD_POSTINGS, HOT = 1 << 17, 1 << 15
#: Bytes of filters that every task may hold, and changes after which the postings are written as one table.
FILTER_BYTES, PARTS = 64 << 20, 16
#: Bytes of hot keys that may be broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20
#: Fingerprints in one bucket, moves before an insertion counts as failed, share of slots to use.
BUCKET, MOVES, LOAD = 4, 500, 0.85


def key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def _long(k: bytes, least: int) -> bool:
    """Whether the key has at least ``least`` code points."""
    return len(k) >= least and (len(k) >= 4 * least or len(k.decode("utf-8", "replace")) >= least)


def digest(k: bytes) -> bytes:
    return hashlib.blake2b(k, digest_size=16).digest()


def _keys(text: bytes | None, least: int) -> list[bytes | None]:
    """For each line its digest, or None if its key is too short."""
    found = map(key, (text or b"").split(b"\n"))
    return [digest(k) if _long(k, least) else None for k in found]


# ---- cuckoo filters


def _alternate(bucket: np.ndarray, mark: np.ndarray, mask: int) -> np.ndarray:
    """The other bucket of a fingerprint; applied twice it gives the first again."""
    return bucket ^ ((mark.astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(mask))


class Cuckoo:
    """A cuckoo filter of 16-bit fingerprints over 128-bit digests."""

    def __init__(self, slots: np.ndarray):
        self.slots, self.mask = slots, len(slots) - 1

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(keys, 1) / (BUCKET * LOAD)))))
        return cls(np.zeros((buckets, BUCKET), np.uint16))

    @classmethod
    def of(cls, digests: list[bytes]) -> Cuckoo:
        made = cls.sized(len(digests))
        while not all(made.add(d) for d in digests):
            made = cls(np.zeros((2 * len(made.slots), BUCKET), np.uint16))
        return made

    @classmethod
    def load(cls, blob: bytes) -> Cuckoo:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, BUCKET).copy())

    def dump(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets; digests as rows of two uint64."""
        mark = (digests[:, 1] >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
        first = digests[:, 1] & np.uint64(self.mask)
        return mark, first, _alternate(first, mark, self.mask)

    def _place(self, d: bytes) -> tuple[np.uint16, int, int]:
        mark, first, second = self._places(np.frombuffer(d, np.uint64).reshape(1, 2))
        return mark[0], int(first[0]), int(second[0])

    def add(self, d: bytes) -> bool:
        mark, first, second = self._place(d)
        for bucket in (first, second):
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = mark
                return True
        bucket = second
        for move in range(MOVES):
            slot = (move * 7 + bucket) % BUCKET
            mark, self.slots[bucket, slot] = self.slots[bucket, slot], mark
            bucket = int(_alternate(np.array([bucket], np.uint64), np.array([mark]), self.mask)[0])
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = mark
                return True
        return False

    def discard(self, d: bytes) -> None:
        """Forget one key that was added."""
        mark, first, second = self._place(d)
        for bucket in (first, second):
            held = np.flatnonzero(self.slots[bucket] == mark)
            if len(held):
                self.slots[bucket, held[0]] = 0
                return

    def may_hold(self, digests: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(digests)
        return (self.slots[first] == mark[:, None]).any(1) | (self.slots[second] == mark[:, None]).any(1)


def shard_of(digests: np.ndarray, shards: int) -> np.ndarray:
    return (digests[:, 0] % np.uint64(shards)).astype(np.int64)


def _rows(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


# ---- exact tables


def postings(docs: DataFrame, least_length: int) -> DataFrame:
    """(key, doc_id, n_lines): the exact reference counts of every long enough line key in every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys, ids, counts = [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch), strict=True):
                own: dict[bytes, int] = {}
                for k in _keys(text, least_length):
                    if k is not None:
                        own[k] = own.get(k, 0) + 1
                keys += own
                counts += own.values()
                ids += [doc] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(counts, pa.int64())], names=["key", "doc_id", "n_lines"])

    found = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "key binary, doc_id long, n_lines long")
    return found.groupBy("key", "doc_id").agg(F.sum("n_lines").alias("n_lines"))


def references(posted: DataFrame, least_docs: int) -> DataFrame:
    """(key, n_docs, keep_id) of the keys that at least ``least_docs`` documents hold."""
    return posted.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keep_id")).where(F.col("n_docs") >= least_docs)


def _with_shard(keys: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("shard", pa.array(shard_of(_rows(batch.column("key").to_pylist()), shards)))

    return keys.mapInArrow(run, ", ".join([*(f"{n} {t}" for n, t in keys.dtypes), "shard long"]))


def filters(refs: DataFrame, shards: int) -> DataFrame:
    """(shard, blob): a cuckoo filter for each shard that has keys."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": part["shard"].iloc[:1], "blob": [Cuckoo.of(list(part["key"])).dump()]})

    return _with_shard(refs.select("key"), shards).groupBy("shard").applyInPandas(build, "shard long, blob binary")


def shards_for(postings: int) -> int:
    return max(16, -(-postings // SHARD_POSTINGS))


def updated(held: DataFrame, added: DataFrame, gone: DataFrame, shards: int) -> DataFrame:
    """Filters after keys were added and others forgotten, each shard by its owner.

    A shard whose filter fills up can't be enlarged from fingerprints alone; its blob becomes null and ``LineIndex``
    rebuilds it from the exact table.
    """
    changes = _with_shard(added.select("key"), shards).withColumn("more", F.lit(True)).unionByName(_with_shard(gone.select("key"), shards).withColumn("more", F.lit(False)))

    def change(old: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        shard = (old if len(old) else part)["shard"].iloc[0]
        if not len(old):
            return pd.DataFrame({"shard": [shard], "blob": [Cuckoo.of(list(part["key"])).dump()]})
        if old["blob"].iloc[0] is None:
            return old
        held = Cuckoo.load(old["blob"].iloc[0])
        for k in part.loc[~part["more"].astype(bool), "key"]:
            held.discard(k)
        whole = all([held.add(k) for k in part.loc[part["more"].astype(bool), "key"]])
        return pd.DataFrame({"shard": [shard], "blob": [held.dump() if whole else None]})

    return held.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, "shard long, blob binary")


def suspects(posted: DataFrame, filter_rows: DataFrame, shards: int) -> DataFrame:
    """The postings whose key its shard's filter may hold."""
    size = filter_rows.agg(F.sum(F.octet_length("blob"))).first()[0] or 0
    return _by_all(posted, filter_rows, shards) if size <= FILTER_BYTES else _by_shard(posted, filter_rows, shards)


def _by_all(posted: DataFrame, filter_rows: DataFrame, shards: int) -> DataFrame:
    """``suspects`` where the postings lie: nothing is shuffled."""
    shared = posted.sparkSession.sparkContext.broadcast({r.shard: bytes(r.blob) for r in filter_rows.collect()})

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: dict[int, Cuckoo] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            digests = _rows(batch.column("key").to_pylist())
            owner, found = shard_of(digests, shards), np.zeros(batch.num_rows, bool)
            order = np.argsort(owner, kind="stable")
            for mine in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1):
                shard = int(owner[mine[0]])
                if shard in shared.value:
                    if shard not in loaded:
                        loaded[shard] = Cuckoo.load(shared.value[shard])
                    found[mine] = loaded[shard].may_hold(digests[mine])
            yield batch.filter(pa.array(found))

    return posted.mapInArrow(probe, ", ".join(f"{n} {t}" for n, t in posted.dtypes))


def _by_shard(posted: DataFrame, filter_rows: DataFrame, shards: int) -> DataFrame:
    """``suspects`` in the tasks that own the shards."""
    names = posted.columns
    schema = ", ".join(f"{n} {t}" for n, t in posted.dtypes)

    def probe(part: pa.Table, held: pa.Table) -> pa.Table:
        part = part.select(names)
        if not part.num_rows or not held.num_rows:
            return part.slice(0, 0)
        found = Cuckoo.load(held.column("blob")[0].as_py()).may_hold(_rows(part.column("key").to_pylist()))
        return part.filter(pa.array(found))

    return _with_shard(posted, shards).groupBy("shard").cogroup(filter_rows.groupBy("shard")).applyInArrow(probe, schema)


class LineIndex:
    """The exact tables and filters of a corpus. Insertions and deletions give a new index; the old one stays valid."""

    def __init__(self, posted: DataFrame, refs: DataFrame, filter_rows: DataFrame, shards: int, least_length: int, least_docs: int, changes: int = 0):
        self.posted, self.refs, self.filter_rows, self.shards = posted, refs, filter_rows, shards
        self.least_length, self.least_docs, self.changes = least_length, least_docs, changes

    @classmethod
    def build(cls, docs: DataFrame, least_length: int = 40, least_docs: int = 5) -> LineIndex:
        return cls._of(settle(postings(docs, least_length)), None, least_length, least_docs)

    @classmethod
    def _of(cls, posted: DataFrame, refs: DataFrame | None, least_length: int, least_docs: int) -> LineIndex:
        refs = settle(references(posted, least_docs)) if refs is None else refs
        shards = shards_for(posted.count())
        return cls(posted, refs, settle(filters(refs, shards)), shards, least_length, least_docs)

    def insert(self, docs: DataFrame) -> LineIndex:
        """With more documents. A document whose id is already known adds its lines to it."""
        new = settle(postings(docs, self.least_length))
        return self._after(self.posted.unionByName(new), new.select("key").distinct())

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Without the documents of these ids (column doc_id)."""
        gone = settle(doc_ids.select(F.col("doc_id").cast("long").alias("gone_id")).distinct())
        told = small(gone, 32, BROADCAST_BYTES)
        lost = self.posted.join(told, F.col("doc_id") == F.col("gone_id"), "left_semi")
        return self._after(self.posted.join(told, F.col("doc_id") == F.col("gone_id"), "left_anti"), lost.select("key").distinct())

    def _after(self, posted: DataFrame, keys: DataFrame) -> LineIndex:
        """The index of ``posted``, which differs from the one before in postings of ``keys`` only."""
        touched = small(settle(keys), 64, BROADCAST_BYTES)
        mine = posted.join(touched, "key", "left_semi").groupBy("key", "doc_id").agg(F.sum("n_lines").alias("n_lines"))
        now, before = settle(references(mine, self.least_docs)), self.refs.join(touched, "key", "left_semi")
        refs = settle(self.refs.join(touched, "key", "left_anti").unionByName(now))
        if self.changes + 1 >= PARTS:
            whole = settle(posted.groupBy("key", "doc_id").agg(F.sum("n_lines").alias("n_lines")))
            if shards_for(whole.count()) > 2 * self.shards:
                return LineIndex._of(whole, refs, self.least_length, self.least_docs)
            posted = whole
        held = settle(updated(self.filter_rows, now.join(before, "key", "left_anti"), before.join(now, "key", "left_anti"), self.shards))
        full = held.where("blob is null").select("shard")
        if full.limit(1).count():
            again = filters(_with_shard(refs.select("key"), self.shards).join(full, "shard", "left_semi").select("key"), self.shards)
            held = settle(held.where("blob is not null").unionByName(again))
        return LineIndex(posted, refs, held, self.shards, self.least_length, self.least_docs, (self.changes + 1) % PARTS)

    def drops(self) -> DataFrame:
        """(doc_id, keys): the line keys that each document loses."""
        hot = settle(self.refs.where(F.col("n_docs") >= HOT).select("key", "keep_id"))
        hottest = small(hot, 64, BROADCAST_BYTES)
        rest = suspects(self.posted.join(hottest, "key", "left_anti"), self.filter_rows, self.shards)
        found = rest.join(self.refs.where(F.col("n_docs") < HOT).select("key", "keep_id"), "key").unionByName(self.posted.join(hottest, "key"))
        return found.where("doc_id <> keep_id").groupBy("doc_id").agg(F.collect_set("key").alias("keys"))

    def _kept(self, docs: DataFrame, columns: list[str], text_too: bool) -> DataFrame:
        """``row`` (the named columns), the text that is left, n_lines and n_dropped of every row."""
        least = self.least_length
        lost = self.drops().select(F.col("doc_id").alias("id"), "keys")
        read = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").alias("own"), "text").join(lost, F.col("own") == F.col("id"), "left").select("row", "text", "keys")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                texts, total, dropped = [], [], []
                for text, keys in zip(text_bytes(batch), batch.column("keys").to_pylist(), strict=True):
                    n, k = (text or b"").count(b"\n") + 1, 0
                    if keys and text:
                        gone, lines = set(keys), text.split(b"\n")
                        kept = [line for line, d in zip(lines, _keys(text, least), strict=True) if d is None or d not in gone]
                        text, k = b"\n".join(kept), n - len(kept)
                    texts.append(text if text_too else hashlib.sha256(text or b"").hexdigest().encode())
                    total.append(n)
                    dropped.append(k)
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())], names=["row", "text", "n_lines", "n_dropped"])

        schema = T.StructType([read.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
        return read.mapInArrow(run, schema)

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` without repeated lines. Texts that lose nothing stay byte for byte."""
        names = docs.columns
        made = self._kept(docs, [c for c in names if c != "text"], True)
        return made.select(*("text" if c == "text" else F.col("row").getField(c).alias(c) for c in names))

    def report(self, docs: DataFrame) -> DataFrame:
        """Per row: doc_id, n_lines, n_dropped and the SHA-256 of the text that is left."""
        return self._kept(docs, ["doc_id"], False).select("row.doc_id", "n_lines", "n_dropped", F.col("text").alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return LineIndex.build(docs).report(docs)


QUERIES = {"op7_line_dedup": op7_line_dedup}
ORACLE_SQL = {
    "op7_line_dedup": r"""
        WITH l AS (SELECT doc_id, i, line, translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
                   FROM (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), E'\n') AS ls FROM documents))),
             r AS (SELECT k, max(doc_id) AS keep_id FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
             d AS (SELECT l.doc_id, i, line, keep_id IS NOT NULL AND keep_id <> l.doc_id AS dropped FROM l LEFT JOIN r ON l.k = r.k)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, E'\n' ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
        FROM d GROUP BY doc_id"""
}
