"""Substring dedup by content-defined chunking.

A gear rolling hash runs over the bytes of a text and cuts it wherever some bits of the hash are zero. The hash
depends on the last bytes alone, so an insertion moves no cut but those beside it and a passage is cut alike wherever
it stands. Chunks are known by their digests; a digest that several documents hold is a repeated chunk, the least id
keeps it. Neighbouring repeated chunks of a document make a repeated passage, which counts if it has enough words.

A repeated passage begins and ends inside a chunk. So the runs are seeds: each is extended byte by byte to both sides
against the texts that keep its chunks, and the words of what comes out are counted. An extension ends before the next
chunk that is long enough to compare does, or that chunk would be in the run too; the bytes up to there are all that is
compared. A passage without a whole chunk in it has no seed and isn't seen.

Defined results: null and empty texts have no chunks; rows that repeat an id count as one document, each has the passages
of its own text, and ``mark`` tells them apart; rows with a null id can't be named and have no passages; an empty table
gives no rows; extra columns, whatever their names, are kept by ``cut``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, settle, slices, table, text_bytes

#: A cut falls where these bits (11 to 15) are zero: every 32 bytes on average. They depend on the last 12 to 16 bytes.
MASK = np.uint32(0xF800)
#: Shorter chunks aren't compared; they belong to a passage if the chunks around them do.
LEAST_BYTES = 12
#: Words of a repeated passage, those it cuts into included.
LEAST_WORDS = 51
#: A cut depends on that many bytes.
REACH = 16

# 256 random numbers, from a fixed seed
GEAR = np.random.default_rng(20_240_229).integers(0, 1 << 32, 256, dtype=np.uint32)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte, h = (h << 1) + GEAR[byte], over the last 16 bytes, by doubling."""
    h = GEAR[data]
    for reach in (1, 2, 4, 8):
        g = h.copy()
        g[reach:] += h[:-reach] << np.uint32(reach)
        h = g
    return h


def _begins(data: np.ndarray) -> np.ndarray:
    """True for each byte that begins a word."""
    space = _SPACE[data]
    return ~space & np.concatenate(([True], space[:-1]))


def chunks(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every chunk, and with them the number of words that begin in it (as a third row of starts)."""
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero((rolling(data) & MASK) == 0) + 1
    if not len(ends) or ends[-1] != len(data):
        ends = np.append(ends, len(data))
    starts = np.concatenate(([0], ends[:-1]))
    return np.stack((starts, ends)), np.add.reduceat(_begins(data), starts)


#: A text and its chunks that are long enough to compare: their digests (128 bits each) and, packed, the rows of ``_spans``.
TEXT = "rid long, doc_id long, mark long, digests binary, spans binary"
SPANS = ("start", "end", "before", "upto", "low", "high")
#: A chunk that meets a repeated digest.
MET = "rid long, doc_id long, idx int, place long, start int, end int, before int, upto int, low int, high int, keep_id long, keep_place long"


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, text) of the texts that can have chunks; ``mark`` tells rows that repeat an id apart."""
    return docs.where("doc_id is not null and text != ''").select("doc_id", _mark("text").alias("mark"), "text")


def _mark(text: str) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF))


def _packed(rows: np.ndarray) -> bytes:
    """Rows of growing numbers as steps, all low bytes before all higher ones: the steps are small, so that most of it is zeros side by side."""
    return np.diff(rows, axis=1, prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes, rows: int = len(SPANS)) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4")
    return np.cumsum(steps.reshape(rows, -1), axis=1, dtype=np.int64)


def _spans(text: bytes) -> np.ndarray:
    """The chunks that are long enough to compare, one in a column: start, end, and words that begin before four places.

    ``before`` and ``upto`` count the words that begin before the chunk's start and end, ``low`` and ``high`` those
    before the furthest bytes that a passage can reach which begins, or ends, with the chunk.
    """
    (starts, ends), _ = chunks(text)
    keep = ends - starts >= LEAST_BYTES
    starts, ends = starts[keep], ends[keep]
    words = np.concatenate(([0], np.cumsum(_begins(np.frombuffer(text, np.uint8)))))
    # before the first chunk, and after the last one, all of the text is within reach
    low = np.maximum(np.concatenate(([0], starts[:-1])) - REACH, 0)[: len(starts)]
    high = np.concatenate((ends[1:], [len(text)]))[: len(starts)]
    return np.stack((starts, ends, words[starts], words[ends], words[low], words[high]))


def chunk_texts(docs: DataFrame) -> DataFrame:
    """One row per text that has chunks to compare, with all of them; ``rid`` numbers the texts, so settle it before it is read twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 36
        for batch in slices(batches, "text"):
            rows: list[tuple[int, int, int, bytes, bytes]] = []
            for doc, mark, text in zip(batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(), text_bytes(batch), strict=True):
                rid += 1
                spans = _spans(text)
                if spans.shape[1]:
                    digests = b"".join([xxhash.xxh3_128_digest(text[a:b]) for a, b in spans[:2].T.tolist()])
                    rows.append((rid, doc, mark, digests, _packed(spans)))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[x.split()[0] for x in TEXT.split(", ")])

    return _texts(docs).mapInArrow(run, TEXT)


def _digests(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The digests of all chunks of a batch, as two rows of numbers, and the number of chunks of each text."""
    counts = pc.binary_length(batch.column("digests")).to_numpy(zero_copy_only=False) // 16
    return np.frombuffer(b"".join(batch.column("digests").to_pylist()), np.int64).reshape(-1, 2).T, counts


def _owned(texts: DataFrame) -> DataFrame:
    """(digest, more, doc_id, place) of every chunk; a place is a text and an offset in it in one number, the mark above, the offset in the low 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "digests"):
            (digest, more), counts = _digests(batch)
            places = np.concatenate([(mark << 32) + _unpacked(spans)[0] for mark, spans in zip(batch.column("mark").to_pylist(), batch.column("spans").to_pylist(), strict=True)])
            ids = np.repeat(batch.column("doc_id").to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (digest, more, ids, places)], names=["digest", "more", "doc_id", "place"])

    return texts.mapInArrow(run, "digest long, more long, doc_id long, place long")


def _numbered(texts: DataFrame) -> DataFrame:
    """(digest, more, rid, idx) of every chunk; all else that is known of it stays with its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "digests"):
            (digest, more), counts = _digests(batch)
            idx = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            rids = np.repeat(batch.column("rid").to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (digest, more, rids, idx.astype(np.int32))], names=["digest", "more", "rid", "idx"])

    return texts.select("rid", "digests").mapInArrow(run, "digest long, more long, rid long, idx int")


def _met(texts: DataFrame, again: DataFrame) -> DataFrame:
    """The chunks that meet a repeated digest, as in ``MET``; only they get their bytes and words back, beside their text."""
    found = _numbered(texts).join(again, ["digest", "more"]).groupBy("rid").agg(F.collect_list(F.struct("idx", "keep_id", "keep_place")).alias("met"))
    joined = texts.select("rid", "doc_id", "mark", "spans").join(found, "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "spans"):
            counts = pc.list_value_length(batch.column("met")).to_numpy(zero_copy_only=False)
            idx, keep_id, keep_place = (x.to_numpy() for x in batch.column("met").flatten().flatten())
            ends = np.cumsum(counts)
            spans = np.concatenate([_unpacked(data)[:, idx[b - n : b]] for data, n, b in zip(batch.column("spans").to_pylist(), counts, ends, strict=True)], axis=1)
            rids, ids, marks = (np.repeat(batch.column(c).to_numpy(), counts) for c in ("rid", "doc_id", "mark"))
            columns = (rids, ids, idx, (marks << 32) + spans[0], *spans.astype(np.int32), keep_id, keep_place)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[x.split()[0] for x in MET.split(", ")])

    return joined.mapInArrow(run, MET)


def repeated(docs: DataFrame) -> DataFrame:
    """(digest, more, keep_id, keep_place): digests (128 bits) that more than one document holds, with the least of their ids and a place there."""
    return _repeated(chunk_texts(docs))


def _repeated(texts: DataFrame) -> DataFrame:
    # the least and the largest id differ if there are two documents; both are known before the shuffle
    found = _owned(texts).groupBy("digest", "more").agg(F.min("doc_id").alias("keep_id"), F.max("doc_id").alias("most"), F.min_by("place", "doc_id").alias("keep_place"))
    return found.where("keep_id < most").select("digest", "more", "keep_id", "keep_place")


def _runs(texts: DataFrame, again: DataFrame, by_owner: bool, least_words: int) -> DataFrame:
    """Runs of neighbouring repeated chunks that may be part of a passage; with ``by_owner`` a run also ends where the document becomes, or stops being, the keeper.

    ``texts`` and ``again`` are the settled texts' chunks and repeated digests. ``mates`` are the keepers of a run's chunks, as the
    document and by how much a place there differs from the place here.
    """
    met = _met(texts, again).withColumn("mine", F.col("doc_id") == F.col("keep_id"))
    here = Window.partitionBy("rid").orderBy("idx")
    fresh = F.col("idx") != F.lag("idx").over(here) + 1
    if by_owner:
        fresh = fresh | (F.col("mine") != F.lag("mine").over(here))
    runs = met.withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("int")).withColumn("run", F.sum("fresh").over(here))
    mate = F.when(~F.col("mine"), F.struct("keep_id", (F.col("keep_place") - F.col("place")).alias("away")))
    grouped = runs.groupBy("rid", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("place").alias("place"), F.min("start").alias("start_byte"), F.max("end").alias("end_byte"), F.min("end").alias("first_end"), F.max("start").alias("last_start"),
        (F.max("upto") - F.min("before")).alias("n_words"), (F.max("high") - F.min("low")).alias("most_words"), F.mode("keep_id", True).alias("keep_id"), F.collect_set(mate).alias("mates"), F.first("mine").alias("mine"),
    )
    # one more than there can be, since a passage may begin within a word
    return grouped.where(F.col("most_words") + 1 >= least_words)


def _contexts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc_id, place, side, context): the bytes before (side 0) or after (side 1) each place that ``asked`` names, as far as an extension can go.

    The places that are asked of one text come together; there are two for each of its bytes at most, however many documents ask.
    """
    wanted = asked.groupBy("doc_id", F.shiftright("place", 32).alias("mark")).agg(F.collect_set(F.struct("place", "side")).alias("asked"))
    joined = _texts(docs).join(wanted, ["doc_id", "mark"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows: list[tuple[int, int, int, bytes]] = []
            for doc, mark, text, places in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "mark")), text_bytes(batch), batch.column("asked").to_pylist(), strict=True):
                base = mark << 32
                # a place beyond the text's end is one of an offset that the two texts don't share there
                mine = [(x["place"], x["side"]) for x in places if x["place"] <= base + len(text)]
                (starts, ends), _ = chunks(text)
                keep = ends - starts >= LEAST_BYTES
                starts, ends = starts[keep], ends[keep]
                for place, side in mine:
                    at = place - base
                    # the chunk at the place, and the one beyond it
                    if side:
                        i = int(np.searchsorted(starts, at)) + 1
                        rows.append((doc, place, side, text[at : int(ends[i]) + REACH if i < len(ends) else len(text)]))
                    else:
                        i = int(np.searchsorted(ends, at, "right")) - 2
                        rows.append((doc, place, side, text[max(int(starts[i]) - REACH - 1, 0) if i >= 0 else 0 : at]))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["doc_id", "place", "side", "context"])

    return joined.mapInArrow(run, "doc_id long, place long, side int, context binary")


def shared(one: bytes, other: bytes, side: int) -> int:
    """Bytes that the ends (side 0) or the beginnings (side 1) have in common."""
    n = min(len(one), len(other))
    a, b = (np.frombuffer(x, np.uint8)[:n] if side else np.frombuffer(x, np.uint8)[::-1][:n] for x in (one, other))
    differ = np.flatnonzero(a != b)
    return int(differ[0]) if len(differ) else n


def _beyond(context: bytes, side: int, inner: int, n: int) -> tuple[int, int]:
    """Bytes and words by which the last ``n`` bytes go beyond the ``inner`` ones; never within a character."""
    if side:
        while n > inner and n < len(context) and context[n] & 0xC0 == 0x80:
            n -= 1
    else:
        while n > inner and context[-n] & 0xC0 == 0x80:
            n -= 1
    if n <= inner:
        return 0, 0
    begins = _begins(np.frombuffer(context, np.uint8))
    if side:
        return n - inner, int(begins[inner:n].sum())
    at, stop = len(context) - n, len(context) - inner
    # a word that the passage begins within counts too
    return n - inner, int(begins[at + 1 : stop].sum()) + (not _SPACE[context[at]])


def _extended(docs: DataFrame, runs: DataFrame, by_owner: bool) -> DataFrame:
    """(doc_id, place, side, inner, mine, ext), settled: how far the passage goes beyond the run's edge there, bytes << 32 | words; the keepers' sides too."""
    base = F.col("place") - F.col("start_byte")
    edge = F.explode(F.array(F.struct(F.lit(0).alias("side"), (base + F.col("first_end")).alias("place"), (F.col("first_end") - F.col("start_byte")).alias("inner")), F.struct(F.lit(1).alias("side"), (base + F.col("last_start")).alias("place"), (F.col("end_byte") - F.col("last_start")).alias("inner"))))
    edges = runs.select("doc_id", edge.alias("e"), "mates").select("doc_id", "e.*", F.explode("mates").alias("m"))
    pairs = settle(edges.select("doc_id", "place", "side", "inner", F.col("m.keep_id").alias("other_id"), (F.col("place") + F.col("m.away")).alias("other_place")).distinct(), tidy=True)
    asked = pairs.select("doc_id", "place", "side").unionByName(pairs.select(F.col("other_id").alias("doc_id"), F.col("other_place").alias("place"), "side")).distinct()
    found = settle(_contexts(docs, asked), tidy=True)
    theirs = found.select(F.col("doc_id").alias("other_id"), F.col("place").alias("other_place"), "side", F.col("context").alias("other"))
    both = pairs.join(found, ["doc_id", "place", "side"]).join(theirs, ["other_id", "other_place", "side"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "context"):
            best: dict[tuple[int, int, int, int, bool], int] = {}
            for doc, place, side, inner, other_id, other_place, context, other in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "place", "side", "inner", "other_id", "other_place", "context", "other")), strict=True):
                n = shared(context, other, side)
                for key, text in (((doc, place, side, inner, False), context), ((other_id, other_place, side, inner, by_owner), other)):
                    more, words = _beyond(text, side, inner, n)
                    if more:
                        best[key] = max(best.get(key, 0), more << 32 | words)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in best], t) for i, t in enumerate(types)), pa.array(list(best.values()), pa.int64())], names=["doc_id", "place", "side", "inner", "mine", "ext"])

    told = both.select("doc_id", "place", "side", "inner", "other_id", "other_place", "context", "other").mapInArrow(run, "doc_id long, place long, side int, inner int, mine boolean, ext long")
    far = settle(told.groupBy("doc_id", "place", "side", "inner", "mine").agg(F.max("ext").alias("ext")), tidy=True)
    discard(pairs)
    discard(found)
    return far


def passages(docs: DataFrame, least_words: int = LEAST_WORDS, by_owner: bool = False) -> DataFrame:
    """(doc_id, mark, start_byte, end_byte, n_words, keep_id, kept): the repeated passages of every document, the keeper's too.

    ``mark`` is a hash of the text that the bytes are counted in. ``keep_id`` is the document that keeps most of the passage's chunks; ``kept`` is true in that document.
    """
    texts = settle(chunk_texts(docs), tidy=True)
    again = settle(_repeated(texts), tidy=True)
    runs = settle(_runs(texts, again, by_owner, least_words), tidy=True)
    discard(texts)
    discard(again)
    far = _extended(docs, runs, by_owner)
    base = F.col("place") - F.col("start_byte")
    found = runs.withColumns({"at0": base + F.col("first_end"), "at1": base + F.col("last_start"), "inner0": F.col("first_end") - F.col("start_byte"), "inner1": F.col("end_byte") - F.col("last_start"), "flag": F.col("mine") if by_owner else F.lit(False)})
    for side in (0, 1):
        beyond = far.where(F.col("side") == side).select("doc_id", F.col("place").alias(f"at{side}"), F.col("inner").alias(f"inner{side}"), F.col("mine").alias("flag"), F.col("ext").alias(f"ext{side}"))
        found = found.join(beyond, ["doc_id", f"at{side}", f"inner{side}", "flag"], "left")
    more = {side: F.coalesce(F.shiftright(f"ext{side}", 32), F.lit(0)).cast("int") for side in (0, 1)}
    words = sum((F.coalesce(F.col(f"ext{side}").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(0)) for side in (0, 1)), F.col("n_words").cast("long"))
    told = found.select("doc_id", F.shiftright(base, 32).alias("mark"), (F.col("start_byte") - more[0]).alias("start_byte"), (F.col("end_byte") + more[1]).alias("end_byte"), words.alias("n_words"), "keep_id", (F.col("doc_id") == F.col("keep_id")).alias("kept"))
    return told.where(F.col("n_words") >= least_words)


def cut(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` without repeated passages, but for the document that keeps each. Untouched texts stay byte for byte."""
    gone = passages(docs, least_words, by_owner=True).where("not kept").groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("its")).agg(F.collect_set(F.struct("start_byte", "end_byte")).alias("spans"))
    names = docs.columns
    rest = [c for c in names if c != "text"]
    read = docs.select(F.struct(*rest).alias("row"), F.col("doc_id").alias("own"), _mark("text").alias("whose"), "text")
    joined = read.join(gone, (F.col("own") == F.col("id")) & (F.col("whose") == F.col("its")), "left").select("row", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [_without(text, [(x["start_byte"], x["end_byte"]) for x in spans]) if spans else text for text, spans in zip(text_bytes(batch), batch.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.binary()).cast(pa.string())], names=["row", "text"])

    made = joined.mapInArrow(run, T.StructType([read.schema["row"], T.StructField("text", T.StringType())]))
    return made.select(*("text" if c == "text" else F.col("row").getField(c).alias(c) for c in names))


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans, which may overlap; characters stay whole."""
    done = len(text)
    for start, end in sorted(spans, reverse=True):
        a, b = start, min(end, done)
        done = min(a, done)
        while a < len(text) and text[a] & 0xC0 == 0x80:
            a += 1
        while b < len(text) and text[b] & 0xC0 == 0x80:
            b += 1
        if a < b:
            text = text[:a] + text[b:]
    return text


def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"))


QUERIES = {"op4_chunk_dedup": op4_chunk_dedup}
