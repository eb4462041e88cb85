"""Personal data: four base patterns, and contextual extraction bootstrapped from them.

Seeds are the base spans and words of a secret's shape (long, of letters and digits mixed). The two words before an
identifier, digits as ``#``, are a lexical pattern. All identifiers of all texts and their patterns make a graph, and
Spark scores it iteratively: a pattern is worth the mean score of what follows it, a seed 1, any word that doesn't
look like an identifier 0, and an identifier that is no seed the mean score of the patterns before it. So identifiers
that are found lend weight to further patterns. Patterns that end up above a high bar, with enough different
identifiers that are sure themselves, mark what follows them as spans of kind ``id``. Base spans are never touched.

Tasks know the patterns by a table of bits of fixed size; what it lets through by mistake goes in exact joins, so
there may be any number of patterns.

Defined results: a null text is empty and has no spans; overlapping spans of different kinds all stay; repeated ids
are judged row by row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, slices, small, table

KINDS = ("email", "ip", "card", "phone")
#: Different sure identifiers that a pattern needs, the score that it and they need in the end, rounds of scoring.
LEAST_SEEDS, LEAST_SCORE, ROUNDS = 3, 0.8, 4
#: Bits of the table that tells tasks which patterns to look at.
BITS = 1 << 24
BROADCAST_BYTES = 32 << 20

_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# starting only at the first digit of a run changes nothing, since a run that fails there fails at all its digits
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\S+")
_DIGIT_WORD = re.compile(r"\S*[0-9]\S*")
#: What a secret looks like: a long word, with at least ``SHAPE_LEAST`` letters and as many digits.
_SHAPE, SHAPE_LEAST = re.compile(r"[A-Za-z0-9+/=_-]{20,}"), 4
_EDGE = ".,;:!?\"'()[]{}<>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each ``@`` outwards, in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _octets(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _card(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def _phone(found: str) -> bool:
    return 8 <= sum(c in "0123456789" for c in found) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind and start; matches that fail their test are dropped without retry."""
    out = [(0, a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for kind, pattern, passes in ((1, _IP, _octets), (2, _CARD, _card), (3, _PHONE, _phone)):
            if kind != 3 or "+" in text:
                out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if passes(m[0])]
    return out


def _pair(a: str, b: str) -> int:
    return xxhash.xxh3_64_intdigest(_DIGIT.sub("#", f"{a} {b}".lower()).encode()) >> 1


def _pattern(text: str, start: int) -> int | None:
    """The hash of the two words before the word that begins at a place, but for punctuation; None if there aren't two."""
    while start and text[start - 1] in _EDGE:
        start -= 1
    if not start or not text[start - 1].isspace():
        return None
    width = 128
    while len(before := text[max(0, start - width) : start].split()) < 3 and width < start:
        width *= 4  # the first word of a part of the text may be cut
    return _pair(before[-2], before[-1]) if len(before) > 1 else None


def _instance(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.lower().encode()) >> 1


def _secret(word: str) -> bool:
    return bool(_SHAPE.fullmatch(word)) and sum(map(str.isdigit, word)) >= SHAPE_LEAST and sum(map(str.isalpha, word)) >= SHAPE_LEAST


def identifiers(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """(start, end) of the words that look like identifiers, without the punctuation around them: at least 6 characters
    and a digit. Those that base spans overlap aren't among them."""
    held = sorted((a, b) for _, a, b in base)
    at = 0
    for m in _DIGIT_WORD.finditer(text):
        bare = m[0].strip(_EDGE)
        if len(bare) < 6:
            continue
        start = m.start() + m[0].index(bare)
        end = start + len(bare)
        while at < len(held) and held[at][1] <= start:
            at += 1
        if not any(a < end and start < b for a, b in held[at : at + 8]):
            yield start, end


def _edges(docs: DataFrame) -> DataFrame:
    """(pattern, instance, seed, n): how often an identifier follows a pattern, and whether it is a seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found: dict[tuple[int, int, bool], int] = {}
            for text in batch.column("text").to_pylist():
                if not text or not ("@" in text or _DIGIT.search(text)):
                    continue
                base = base_spans(text)
                places = [(a, b, True) for _, a, b in base] + [(a, b, _secret(text[a:b])) for a, b in identifiers(text, base)]
                for start, end, seed in places:
                    if (p := _pattern(text, start)) is not None:
                        edge = p, _instance(text[start:end]), seed
                        found[edge] = found.get(edge, 0) + 1
            columns = [pa.array([e[i] for e in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(found.values()), pa.int64())], names=["pattern", "instance", "seed", "n"])

    found = docs.select("text").mapInArrow(run, "pattern long, instance long, seed boolean, n long")
    return found.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.sum("n").alias("n"))


def marks(patterns: DataFrame) -> np.ndarray:
    """A table of ``BITS`` bits with those of the patterns set; at most ``BITS`` / 64 numbers reach the driver."""
    at = F.pmod("pattern", F.lit(BITS))
    rows = patterns.select((at / 64).cast("int").alias("place"), F.expr(f"shiftleft(1L, cast(pmod(pattern, {BITS}) % 64 as int))").alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(BITS // 64, np.int64)
    out[rows["place"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def _others(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """(pattern, others): how often a word that doesn't look like an identifier follows a pattern that ``known`` has, or may have."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, hashed = np.unpackbits(shared.value)[:BITS].tobytes(), xxhash.xxh3_64_intdigest
        for batch in slices(batches, "text"):
            found: dict[int, int] = {}
            for text in batch.column("text").to_pylist():
                # as in _pair, but once for the whole text
                words = _DIGIT.sub("#", (text or "").lower()).split()
                at = [(i + 2, p) for i, (a, b) in enumerate(pairwise(words)) if wanted[(p := hashed(f"{a} {b}".encode()) >> 1) % BITS]]
                if not at:
                    continue
                base = base_spans(text)
                taken = {a for _, a, _ in base} | {a for a, _ in identifiers(text, base)}
                places = [(m.start(), m.start() + len(m[0]) - len(m[0].lstrip(_EDGE))) for m in _WORD.finditer(text)] if taken else ()
                for i, p in at:
                    # identifiers and seeds are counted already, however they look
                    if i < len(words) and not (taken and not taken.isdisjoint(places[i])):
                        found[p] = found.get(p, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["pattern", "others"])

    return docs.select("text").mapInArrow(run, "pattern long, others long").groupBy("pattern").agg(F.sum("others").alias("others"))


def patterns(docs: DataFrame, least_seeds: int = LEAST_SEEDS, least_score: float = LEAST_SCORE) -> DataFrame:
    """(pattern, score) of the patterns that are trusted in the end."""
    graph = settle(_edges(docs))
    enough = settle(graph.groupBy("pattern").agg(F.count("*").alias("instances")).where(F.col("instances") >= least_seeds).select("pattern"))
    edges = settle(graph.join(small(enough, 32, BROADCAST_BYTES), "pattern", "left_semi"))
    others = settle(_others(docs, marks(enough)).join(small(enough, 32, BROADCAST_BYTES), "pattern", "left_semi"))
    sure = F.when(F.col("seed"), 1.0)
    scored = edges.withColumn("s", sure.otherwise(0.0))
    worth = None
    for _ in range(ROUNDS):
        sums = scored.groupBy("pattern").agg(F.sum(F.col("n") * F.col("s")).alias("good"), F.sum("n").alias("n"), F.count_if(F.col("s") >= least_score).alias("seeds"))
        share = F.col("good") / (F.col("n") + F.coalesce("others", F.lit(0)))
        worth = settle(sums.join(others, "pattern", "left").select("pattern", "seeds", share.alias("score")))
        # a pattern with too few sure identifiers says nothing about others
        told = edges.where("not seed").join(worth, "pattern").withColumn("score", F.when(F.col("seeds") >= least_seeds, F.col("score")).otherwise(0.0))
        found = settle(told.groupBy("instance").agg((F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("found")))
        scored = edges.join(found, "instance", "left").withColumn("s", sure.otherwise(F.coalesce("found", F.lit(0.0))))
    return worth.where((F.col("score") >= least_score) & (F.col("seeds") >= least_seeds)).select("pattern", "score")


def marked(text: str, base: list[tuple[int, int, int]], looks) -> list[tuple[int, int, int]]:
    """(pattern, start, end) of the identifiers after patterns that ``looks`` is true of."""
    if not _DIGIT.search(text):
        return []
    return [(p, a, b) for a, b in identifiers(text, base) if (p := _pattern(text, a)) is not None and looks(p)]


def _told(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


READ = "rid long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, marked array<struct<pattern:long,start:int,end:int>>"


def find(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Every document with its counts and spans (kind:start:end in code points, end exclusive)."""
    trusted = settle(trusted.select("pattern"))
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(marks(trusted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(shared.value)[:BITS].tobytes()
        looks = (lambda p: known[p % BITS]) if b"\1" in known else None
        rid = TaskContext.get().partitionId() << 36
        for batch in slices(batches, "text"):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                base = base_spans(text or "")
                told = _told([(KINDS[k], a, b) for k, a, b in base])
                more = marked(text or "", base, looks) if looks else []
                rows.append((rid, doc, *(sum(x[0] == k for x in base) for k in range(4)), hashlib.sha256(told.encode()).hexdigest(), told, [{"pattern": p, "start": a, "end": b} for p, a, b in more]))
                rid += 1
            types = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.list_(pa.struct([("pattern", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))]
            names = ["rid", "doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "marked"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    read = settle(docs.select("doc_id", "text").mapInArrow(run, READ))
    each = read.where(F.size("marked") > 0).select("rid", F.explode("marked").alias("m")).select("rid", "m.*")
    known = each.join(small(trusted, 32, BROADCAST_BYTES), "pattern", "left_semi")
    added = settle(known.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("ids")))
    met = read.join(small(added, 256, BROADCAST_BYTES), "rid", "left").withColumn("ids", F.coalesce("ids", F.expr("cast(array() as array<struct<start:int,end:int>>)")))
    told = F.transform("ids", lambda x: F.concat_ws(":", F.lit("id"), x["start"].cast("string"), x["end"].cast("string")))
    every = F.array_join(F.filter(F.concat(F.array("base"), told), lambda x: x != ""), ",")
    return met.select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", every.alias("spans"), F.size("ids").cast("long").alias("n_id"))


def all_spans(text: str, trusted: frozenset[int]) -> list[tuple[str, int, int]]:
    """Base spans and, by trusted patterns, further identifiers that no base span overlaps."""
    base = base_spans(text)
    return [(KINDS[k], a, b) for k, a, b in base] + [("id", a, b) for _, a, b in marked(text, base, trusted.__contains__)]


def redact(text: str, trusted: frozenset[int] = frozenset()) -> str:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first one."""
    out, at = [], 0
    for kind, start, end in sorted(all_spans(text, trusted), key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
            at = end
    return "".join([*out, text[at:]])


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs, settle(patterns(docs)))


QUERIES = {"op3_pii": op3_pii}
