"""Benchmark decontamination with a generalised suffix automaton.

The words of the test items are cut into overlapping parts in tasks and dealt to blocks by a hash. The items of a block
become a suffix automaton over words in flat arrays, so one block holds about a million words; only one block at a time
reaches the driver and is broadcast, so that is bounded however many items there are and however long one is. Every document streams through it word by word and the automaton tracks the
longest match that ends at each word. Where that length reaches the window (or a whole shorter item ends), the words
it covers are hit.

Defined results: null and empty texts have no words and are clean; items without words are never found; repeated ids
are judged row by row; an empty benchmark leaves all documents clean; extra columns are ignored by the query and kept
by ``remove``.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, settle, slices, table, text_bytes

#: Words of items that one automaton holds on average (a word takes some 150 bytes there), and most words of one part
#: of a longer item.
BLOCK_WORDS, PART_WORDS = 1_000_000, 10_000

#: Maps A-Z to a-z, digits, letters and bytes of non-ASCII characters to themselves, all else to a space.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD).split() if text else []


class Automaton:
    """Generalised suffix automaton over the words of the items of one block.

    Everything is in flat arrays by state. ``link`` is the suffix link and ``length`` the longest string. Most states
    have one transition: on ``word`` to ``goes``; further ones are in the dict ``more``. ``owner`` is the item whose
    full window a state stands for, ``several`` has the rest where there are more, ``ends`` the items that end short of
    a window. ``shorter`` is the nearest state on the link path (itself included) at which such an item ends.
    """

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        self.word, self.goes, self.link, self.length = array("i", [-1]), array("i", [-1]), array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}
        self.items = list(dict.fromkeys(item for item, _ in items))
        place = {item: n for n, item in enumerate(self.items)}
        paths = [(place[item], array("i", [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in found])) for item, found in items if found]
        for _, ids in paths:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        # a state stands for its longest string and the suffixes down to its link's length
        self.owner = array("i", [-1]) * len(self.link)
        self.several: dict[int, set[int]] = {}
        self.ends: dict[int, set[int]] = {}
        for item, ids in paths:
            state = 0
            for n, word in enumerate(ids, 1):
                state = self.step(state, word)
                if n >= window:
                    at = self.at(state, window)
                    if self.owner[at] < 0:
                        self.owner[at] = item
                    elif self.owner[at] != item:
                        self.several.setdefault(at, set()).add(item)
            if len(ids) < window:
                self.ends.setdefault(state, set()).add(item)
        self.shorter = array("i", [-1]) * len(self.link)
        if self.ends:
            for state in np.argsort(np.frombuffer(self.length, np.int32), kind="stable").tolist():
                self.shorter[state] = state if state in self.ends else self.shorter[self.link[state]] if state else -1

    def step(self, state: int, word: int) -> int:
        """The state that a word leads to, or -1."""
        if self.word[state] == word:
            return self.goes[state]
        more = self.more.get(state)
        return more.get(word, -1) if more else -1

    def _lead(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.goes[state] = word, to
        else:
            self.more.setdefault(state, {})[word] = to

    def _state(self, word: int, goes: int, link: int, length: int) -> int:
        for column, value in ((self.word, word), (self.goes, goes), (self.link, link), (self.length, length)):
            column.append(value)
        return len(self.link) - 1

    def _clone(self, state: int, parent: int, word: int) -> int:
        """A copy of ``state`` for its strings of up to the parent's length plus one; transitions on the path go there."""
        new = self._state(self.word[state], self.goes[state], self.link[state], self.length[parent] + 1)
        if state in self.more:
            self.more[new] = dict(self.more[state])
        self.link[state] = new
        while parent >= 0 and self.step(parent, word) == state:
            self._lead(parent, word, new)
            parent = self.link[parent]
        return new

    def _extend(self, last: int, word: int) -> int:
        known = self.step(last, word)
        if known >= 0:
            return known if self.length[known] == self.length[last] + 1 else self._clone(known, last, word)
        new = self._state(-1, -1, 0, self.length[last] + 1)
        while last >= 0 and (known := self.step(last, word)) < 0:
            self._lead(last, word, new)
            last = self.link[last]
        if last >= 0:
            self.link[new] = known if self.length[known] == self.length[last] + 1 else self._clone(known, last, word)
        return new

    def at(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of any string of ``state``."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged word spans [start, end) that occurrences of windows cover, and the items they come from."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        state = matched = 0
        known, more, none = self.vocabulary.get, self.more.get, {}
        first, goes, link, length, window = self.word, self.goes, self.link, self.length, self.window
        for i, text in enumerate(found):
            word = known(text)
            if word is None:
                state = matched = 0
                continue
            while (step := goes[state] if first[state] == word else more(state, none).get(word)) is None:
                # every known word leads somewhere from the first state
                state = link[state]
                matched = length[state]
            state, matched = step, matched + 1
            reach = 0
            if matched >= window:
                at = self.at(state, window)
                items.add(self.owner[at])
                items |= self.several.get(at, none.keys())
                reach = window
            # short items: the state itself counts only if its longest string is the match
            end = self.shorter[state] if matched == length[state] else self.shorter[link[state]]
            while end > 0:
                items |= self.ends[end]
                reach = max(reach, length[end])
                end = self.shorter[link[end]]
            if reach:
                start = i + 1 - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, {self.items[n] for n in items}


@lru_cache(maxsize=1)
def _automaton(items: tuple, window: int) -> Automaton:
    return Automaton([(item, words(text)) for item, text in items], window)


def parts(benchmark: DataFrame, window: int, part_words: int = PART_WORDS) -> DataFrame:
    """(item_id, part, n): the words of every item, joined by spaces, and their number; a long item in parts that
    overlap by a window less one word, so that each window is in one part. Items without words have none, equal rows
    count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows, cut, counts = [], [], []
            for i, text in enumerate(text_bytes(batch)):
                found = words(text)
                for at in range(0, max(1, len(found) - window + 1), part_words) if found else ():
                    part = found[at : at + part_words + window - 1]
                    rows.append(i)
                    cut.append(b" ".join(part))
                    counts.append(len(part))
            made = [batch.column("item_id").take(pa.array(rows, pa.int64())), pa.array(cut, pa.binary()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=["item_id", "part", "n"])

    read = benchmark.select("item_id", "text")
    return read.mapInArrow(run, T.StructType([read.schema["item_id"], T.StructField("part", T.BinaryType()), T.StructField("n", T.LongType())])).distinct()


def blocks(benchmark: DataFrame, window: int, most: int = BLOCK_WORDS) -> Iterator[tuple]:
    """The parts in blocks of about ``most`` words, dealt by a hash; one block at a time comes to the driver. Without
    any words there is one empty block."""
    found = settle(parts(benchmark, window))
    n = -(-(found.agg(F.sum("n")).first()[0] or 1) // most)
    for block in range(n):
        held = found.where(F.pmod(F.xxhash64("item_id", "part"), F.lit(n)) == block).select("item_id", "part").collect()
        yield tuple((r.item_id, bytes(r.part)) for r in held)
    discard(found)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, most: int = BLOCK_WORDS, columns: list[str] | None = None, then: tuple | None = None) -> DataFrame:
    """The text of every row, the number of its words, the hit word spans and the items found; before them, as a
    struct ``row``, the named columns (the id).

    Nothing is shuffled. Each block of items is one more pass over the table, which is written between passes, so that
    a worker builds each automaton once and holds one at a time. ``then`` is a step on batches of these columns and its
    schema; it runs in the workers of the last pass, so that no text goes to Python once more for it.
    """
    spark = docs.sparkSession
    out = docs.select(F.struct(*(columns or ["doc_id"])).alias("row"), "text", F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"))
    schema = T.StructType([out.schema["row"], *(T.StructField(f.name, f.dataType) for f in out.schema.fields[1:])])
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    shared = written = run = None
    for block in blocks(benchmark, window, most):
        if shared is not None:
            done, before = shared, written
            out = written = settle(out.mapInArrow(run, schema))
            done.destroy()
            if before is not None:
                discard(before)
        shared = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(shared.value, window)
            for batch in slices(batches, "text"):
                counts, spans, items = [], [], []
                for text, had, names in zip(text_bytes(batch), batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
                    found = words(text)
                    hit, named = automaton.scan(found)
                    counts.append(len(found))
                    spans.append(_merged([(x["start"], x["end"]) for x in had] + hit) if had else hit)
                    items.append(sorted({*names, *(str(x) for x in named if x is not None)}))
                made = [pa.array(counts, pa.int64()), pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], span), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), *made], names=["row", "text", "n_words", "spans", "items"])

        run = scan
    if then is None:
        return out.mapInArrow(run, schema)
    step, made = then
    return out.mapInArrow(lambda batches: step(run(batches)), made)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document: words, hit words, items with occurring windows, and whether it is contaminated."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return matches(docs, benchmark, window).select(
        "row.doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _cut(text: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans and without what stands between them."""
    found = words_at(text)
    out, at = [], 0
    for span in spans:
        out.append(text[at : found[span["start"]][0]])
        at = found[span["end"] - 1][1]
    return b"".join([*out, text[at:]])


def words_at(text: bytes) -> list[tuple[int, int]]:
    """Byte offsets of the words."""
    plain, at, out = text.translate(_WORD), 0, []
    for word in plain.split():
        start = plain.index(word, at)
        at = start + len(word)
        out.append((start, at))
    return out


def remove(docs: DataFrame, benchmark: DataFrame, window: int = 10, most_share: float = 0.5) -> DataFrame:
    """``docs`` without test items: hit spans are cut out of a text, and a document in which more than ``most_share``
    of the words are hit goes. Documents without a hit keep their text byte for byte. Columns are those of ``docs``."""
    names = docs.columns
    rest = [c for c in names if c != "text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, keep = [], []
            for text, n, spans in zip(text_bytes(batch), batch.column("n_words").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                keep.append(sum(s["end"] - s["start"] for s in spans) <= most_share * n)
                texts.append(_cut(text, spans) if spans else text)
            made = dict(zip(rest, batch.column("row").flatten(), strict=True)) | {"text": pa.array(texts, pa.binary()).cast(pa.string())}
            yield pa.RecordBatch.from_arrays([made[c] for c in names], names=names).filter(pa.array(keep))

    return matches(docs, benchmark, window, columns=rest, then=(cut, docs.schema))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op6_decontamination": op6_decontamination}
ORACLE_SQL = {
    "op6_decontamination": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
             b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
             windows AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS gram
                         FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
             sizes AS (SELECT DISTINCT n FROM windows),
             grams AS (SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS gram
                       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)),
             hits AS (SELECT doc_id, item_id, g.n, i FROM grams g JOIN windows v ON g.n = v.n AND g.gram = v.gram),
             covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
             named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id LEFT JOIN named d ON w.doc_id = d.doc_id"""
}
