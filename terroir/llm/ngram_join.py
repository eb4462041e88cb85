"""N-gram Jaccard self-join with token-combination prefixes.

A document is the set of hashes of its word n-grams. Two sets that are similar enough miss few of each other's tokens,
so under one global order (by document frequency, rare tokens first) their prefixes must share tokens. A token that
one document alone holds takes a place in the prefix but needs no index entry, so a document with enough of those is
done. Rare tokens are indexed one by one. Frequent ones are split in classes, a prefix is extended by ``k - 1`` tokens
for each class it touches, and all k-token combinations of one class are indexed instead: similar sets still share a
key, while a token that very many documents hold no longer brings them together.

Document frequencies are exact. Every task deals its tokens out by ranges of hashes, packed by the thousand, and each
range is sorted and counted by itself; the few tokens that a task meets again and again are counted before, and told to
all tasks, so that no range gathers the rows of a hot token. What comes back to a document are its tokens that other
documents hold as well. They make its prefix, and they alone decide how many tokens two sets have in common.

Documents that share a key are not paired with each other. Each key has a pivot, the document with the commonest
tokens, and every document of the key is verified against it; linked documents merge into components. Two documents
that a pivot is the same as, but for a few tokens each, are linked if their differences from it overlap enough. So
those differences are indexed in turn, by prefixes and combinations of tokens again, for the pivot's documents that it
isn't linked with and for what they can be linked with. The documents of a pivot that has few share one key instead, as
comparing them all costs less than those indexes. The new keys get new pivots, as long as that at least halves
the pairs of different components that share a key. What is left is joined on the key and a class of
sizes, a key of very many documents in blocks. Each set brings 512 bits there, the parities of its tokens by classes of hashes: where more bits differ than
linked sets may differ in tokens, the join makes no row. The others are verified, by finer sketches and then by the
tokens. So no link between components is lost, and a group of copies costs as many comparisons as it has documents.

Defined results: null and empty texts, and texts without words, have an empty set, n_shingles 0 and are linked with
nothing; a text of fewer words than an n-gram is one token; rows that repeat an id are documents of their own; a
component whose ids are all null has a null component_id; an empty table gives no rows; extra columns are ignored by the query
and kept by ``one_of_each``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alone, binaries, discard, give_back, numbers, settle, slices, small, table, text_bytes
from .components import stars

#: Tokens that one numpy step takes, and documents (they are numbered by 16 bits there).
CHUNK_TOKENS, CHUNK_DOCS = 1 << 19, 60_000
#: Tokens met so often in one chunk may be hot; at most so many are told to the tasks, the hottest ones.
MET, MOST_TOLD = 4, 1 << 20
#: Tokens that one range of hashes holds on average; least number of ranges, as a power of two.
RANGE_TOKENS, LEAST_BITS = 1 << 20, 5
#: Tokens of at least 2^3 documents are frequent.
FREQUENT = 3
#: Bytes of keys, ids or other join sides that may be broadcast; beyond it the joins shuffle.
BROADCAST_BYTES = 48 << 20
#: Pairs per row of the key table whose bits are simply compared; with more, new pivots are taken.
PAIRS_PER_ROW = 512
#: Longs of parities of a set; rows of a key that one block of the last join holds.
LONGS, BLOCK = 8, 8192
#: Differences from a pivot that one class of them holds, about, when sets are as far from it as linked ones can be.
CLASS = 6

_K = 0x9E3779B97F4A7C15
_U = np.uint64


@dataclass(frozen=True)
class Measure:
    """N-grams of ``words`` words; linked when ``den`` * intersection >= ``num`` * union."""

    words: int = 5
    num: int = 80
    den: int = 100

    def errors(self, n):
        """How many of n tokens a linked set can lack."""
        return n - -(-n * self.num // self.den)

    def holds(self, common, n, m):
        return self.den * common >= self.num * (n + m - common)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def tokens(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of the text's words (A-Z lower-cased, split at ASCII white space)."""
    found = text.lower().split() if text else []
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    if not len(hashed):
        return hashed
    k, factor = min(words, len(hashed)), 1
    total = np.full(len(hashed) - k + 1, k, np.uint64)
    for i in range(k):
        total += hashed[i : len(hashed) - k + 1 + i] * _U(factor)
        factor = factor * _K % (1 << 64)
    return np.unique(_mix(total))


def set_id(found: np.ndarray, seed: int) -> tuple[int, int]:
    """Two signed 64-bit halves of a digest of the set."""
    digest = xxhash.xxh3_128_digest(found.tobytes(), seed=seed)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


# ---- the sets, and the tokens that are hot


SETS = "doc_id long, sid long, proof long, n long, often array<struct<token:long,docs:long>>"


def sets(docs: DataFrame, words: int, seed: int = 0) -> DataFrame:
    """One row per document: its id, the id of its set (null if empty) with more bits of the digest, and the set's size.

    Some rows also carry the tokens that the task has met ``MET`` times or more in the chunk of sets that ends there
    (equal sets count once).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        rows = None

        def told(often: bool) -> pa.RecordBatch:
            ids, sids, proofs, sizes = rows
            tok, n = np.unique(np.concatenate(held), return_counts=True) if often and held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            tok, n = tok[n >= MET], n[n >= MET]
            ends = pa.array([0] * len(sids) + [len(tok)], pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(tok.view(np.int64)), pa.array(n)], names=["token", "docs"]))
            columns = [ids, *(pa.array(x, pa.int64()) for x in (sids, proofs, sizes)), lists]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "sid", "proof", "n", "often"])

        for batch in slices(batches, "text"):
            if rows:
                full = sum(map(len, held)) >= CHUNK_TOKENS
                yield told(full)
                held = [] if full else held
            rows = (batch.column("doc_id"), [], [], [])
            for text in text_bytes(batch):
                found = tokens(text, words)
                sid, proof = set_id(found, seed) if len(found) else (None, None)
                for values, value in zip(rows[1:], (sid, proof, len(found)), strict=True):
                    values.append(value)
                if len(found) and sid not in seen:
                    seen.add(sid)
                    held.append(found)
        if rows:
            yield told(True)

    return docs.select("doc_id", "text").mapInArrow(run, SETS)


def plain_sets(docs: DataFrame, words: int) -> tuple[DataFrame, int]:
    """The settled sets and the seed of their ids, under which no two different sets have the same id."""
    seed = 0
    while True:
        every = settle(sets(docs, words, seed))
        clash = every.where("sid is not null").groupBy("sid").agg(F.min("proof").alias("a"), F.max("proof").alias("b")).where("a <> b")
        if not clash.limit(1).count():
            return every, seed
        discard(every)
        seed += 1


def hot(every: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The hot tokens, sorted, with the logarithm of their number of documents, ``FREQUENT`` at least.

    The least logarithm rises until at most ``MOST_TOLD`` are left, so what the driver gets is bounded whatever the corpus.
    """
    met = every.where(F.size("often") > 0).select(F.explode("often").alias("o")).groupBy("o.token").agg(F.sum("o.docs").alias("docs"))
    most = every.where(F.size("often") > 0).agg(F.sum(F.size("often"))).first()[0] or 0
    counted = settle(met.select("token", F.greatest(F.log2("docs").cast("int"), F.lit(FREQUENT)).alias("level")), most)
    left, least = 0, 0
    for row in counted.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 63 rows
        if left + row["count"] > MOST_TOLD:
            least = row.level + 1
            break
        left += row["count"]
    chosen = counted.where(F.col("level") >= least).toPandas()
    discard(counted)
    values, levels = chosen["token"].to_numpy(np.int64).view(np.uint64), chosen["level"].to_numpy(np.int64)
    order = np.argsort(values)
    return values[order], levels[order]


# ---- exact document frequencies


def _six(values: np.ndarray) -> np.ndarray:
    """The low 48 bits of each value as six bytes."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _from_six(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = data.reshape(-1, 6)
    return out.view("<u8").ravel()


def _edges(group: np.ndarray) -> np.ndarray:
    """Where sorted ``group`` changes, with both ends."""
    return np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(group) else np.zeros(1, np.int64)


ORDINARY, TOLD, DOCS = 0, 1, 2
DEALT = "bucket int, kind int, base long, what binary, whose binary"
SHARED = "part int, kind int, rids binary, keys binary, more binary"


def dealt(docs: DataFrame, words: int, seed: int, bits: int, often: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The tokens of all sets by ranges of hashes (``bucket``): 48 further bits of each hash, and the set's number, as
    16 bits above ``base``. Hot tokens are dealt by the set's number instead, with their level and place among the hot;
    a row of kind ``DOCS`` tells ids and sizes of a chunk's sets. Of equal sets that a task meets only one counts."""
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def rows_of(kind: int, base: int, group: np.ndarray, what: np.ndarray, whose: np.ndarray) -> pa.RecordBatch:
        edges = _edges(group)
        n = len(edges) - 1
        columns = [pa.array(group[edges[:-1]], pa.int32()), pa.array(np.full(n, kind), pa.int32()), pa.array(np.full(n, base), pa.int64()), binaries(what, edges), binaries(whose, edges)]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "kind", "base", "what", "whose"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, levels = shared.value
        base, seen = TaskContext.get().partitionId() << 40, set()
        held: list[np.ndarray] = []
        ids: list[int] = []

        def chunk() -> Iterator[pa.RecordBatch]:
            sizes = np.array([len(x) for x in held])
            found, owner = np.concatenate(held), np.repeat(np.arange(len(held)), sizes)
            about = np.stack((np.array(ids, np.int64), sizes), 1)
            yield rows_of(DOCS, base, np.full(len(held), base & ((1 << bits) - 1)), about, np.arange(len(held)).astype("<u2"))
            at = np.minimum(np.searchsorted(values, found), len(values) - 1) if len(values) else np.zeros(len(found), np.int64)
            is_hot = values[at] == found if len(values) else np.zeros(len(found), bool)
            group, at = owner[is_hot] & ((1 << bits) - 1), at[is_hot]
            order = np.argsort(group, kind="stable")
            yield rows_of(TOLD, base, group[order], _six((levels[at] << 40 | at)[order]), owner[is_hot][order].astype("<u2"))
            found, owner = found[~is_hot], owner[~is_hot]
            order = np.argsort(found)
            found = found[order]
            yield rows_of(ORDINARY, base, (found >> _U(64 - bits)).astype(np.int64), _six(found << _U(bits) >> _U(16)), owner[order].astype("<u2"))

        n = 0
        for batch in slices(batches, "text"):
            for text in text_bytes(batch):
                found = tokens(text, words)
                if not len(found) or (sid := set_id(found, seed)[0]) in seen:
                    continue
                seen.add(sid)
                held.append(found)
                ids.append(sid)
                n += len(found)
                if n >= CHUNK_TOKENS or len(held) >= CHUNK_DOCS:
                    yield from chunk()
                    base, n = base + len(held), 0
                    held.clear()
                    ids.clear()
        if held:
            yield from chunk()

    return docs.select("text").mapInArrow(run, DEALT)


def shared_tokens(rows: DataFrame, bits: int) -> DataFrame:
    """For parts of the sets (``part``): the tokens that more than one set holds, with the logarithm of how many do."""

    def part_of(rids: np.ndarray) -> np.ndarray:
        return ((rids.astype(np.uint64) * _U(_K)) >> _U(64 - bits)).astype(np.int64)

    def rows_of(kind: int, rids: np.ndarray, keys: np.ndarray, more: np.ndarray) -> pa.Table:
        part = part_of(rids)
        order = np.argsort(part, kind="stable")
        edges = _edges(part[order])
        n = len(edges) - 1
        columns = [pa.array(part[order][edges[:-1]], pa.int32()), pa.array(np.full(n, kind), pa.int32()), *(binaries(x[order], edges) for x in (rids, keys, more))]
        return pa.Table.from_arrays(columns, names=["part", "kind", "rids", "keys", "more"])

    def count(group: pa.Table) -> pa.Table:
        out = []
        for kind in (ORDINARY, TOLD, DOCS):
            mine = group.filter(pa.compute.equal(group.column("kind"), kind))
            if not mine.num_rows:
                continue
            whose = [np.frombuffer(x, "<u2").astype(np.int64) + b for x, b in zip(mine.column("whose").to_pylist(), mine.column("base").to_pylist(), strict=True)]
            rids, what = np.concatenate(whose), numbers(mine.column("what"), np.uint8)
            if kind == DOCS:
                about = what.view(np.int64).reshape(-1, 2)
                out.append(rows_of(DOCS, rids, about[:, 0], about[:, 1]))
                continue
            what = _from_six(what)
            if kind == TOLD:
                keys, level = what & _U((1 << 40) - 1), (what >> _U(40)).astype(np.int64)
            else:
                order = np.argsort(what, kind="stable")
                what, rids = what[order], rids[order]
                edges = _edges(what)
                docs = np.repeat(np.diff(edges), np.diff(edges))
                again = docs > 1
                what, rids, level = what[again], rids[again], np.frexp(docs[again])[1] - 1
                keys = what | _U(group.column("bucket")[0].as_py() << 48 & 0x7FFF << 48) | _U(1 << 63)
            if len(keys):
                out.append(rows_of(kind, rids, keys.view(np.int64), level.astype(np.uint8)))
        give_back()
        return pa.concat_tables(out) if out else rows_of(DOCS, *[np.zeros(0, np.int64)] * 3)

    return rows.groupBy("bucket").applyInArrow(count, SHARED)


# ---- prefixes


def combined(found: np.ndarray, missing: int, bits: int, k: int, salt: int) -> tuple[np.ndarray, int]:
    """Keys of the k-combinations within 2^bits classes of the first of ``found``, and how many tokens are still missing.

    It takes tokens until the classes have ``missing`` tokens more than k - 1 each.
    """
    taken: dict[int, list[int]] = {}
    for i, c in enumerate((_mix(found) & _U((1 << bits) - 1)).tolist()):
        if missing <= 0:
            break
        mine = taken.setdefault(c, [])
        mine.append(i)
        missing -= len(mine) >= k
    out = [np.zeros(0, np.uint64)]
    for mine in taken.values():
        if len(mine) >= k:
            key = np.full(1, salt, np.uint64)
            for chosen in np.array(list(combinations(mine, k))).T:
                key = _mix(key * _U(_K) + found[chosen])
            out.append(key)
    return np.concatenate(out), missing


def schemes(n: int, measure: Measure) -> set[int]:
    """Of sets of 2^s to 2^(s+1) tokens it is s, and also s - 1 if a linked set can be that small: linked sets have one in common."""
    scheme = n.bit_length() - 1
    return {scheme, scheme - 1} if n - measure.errors(n) < 1 << scheme else {scheme}


def prefix_keys(found: np.ndarray, level: np.ndarray, missing: int, n: int, measure: Measure, k: int = 2) -> np.ndarray:
    """The index keys of a set of n tokens; ``found`` are those that other sets hold, in order, with their levels.

    ``missing`` tokens are still needed after those that no other set holds. A prefix is long enough when the sum over
    rare tokens, and over classes less k - 1 tokens each, reaches that: then of two linked sets the one whose prefix
    ends first has a rare token, or k tokens of one class, that the other one's prefix has too. Sets of 2^s to 2^(s+1)
    tokens use the classes of scheme s, and also those of scheme s - 1 if a linked set can be that small.
    """
    rare = found[level < FREQUENT][:missing]
    if len(rare) >= missing:
        return rare
    often = found[level >= FREQUENT]
    out = [rare]
    for s in schemes(n, measure):
        left = missing - len(rare)
        # the smallest sets are indexed by single tokens
        out.append(often[:left] if s < 4 else combined(often, left, s - 4, k, s)[0])
    return np.unique(np.concatenate(out))


def difference_keys(mine: tuple[int, np.ndarray, np.ndarray], pivot: tuple[int, np.ndarray, np.ndarray], salt: int, measure: Measure) -> tuple[bool, np.ndarray]:
    """Whether a set is linked with a pivot, and the index keys of what it differs by. Sets are (size, tokens that other sets hold, levels).

    Let P be the pivot's tokens that other sets hold, k of them, and u the others; e what a set differs from P by, and
    o how much the differences of x and y have in common. They are linked if e(x) + e(y) - 2 o <= r (n(x) + n(y)), r
    being (1 - t) / (1 + t) for a similarity of t. If x isn't linked with the pivot, f = e(x) - r (n(x) + k) is above
    -u (1 - r), and it follows that o >= f / (1 + r) and o > (e(y) - r max(0, n(y) - k) - u (1 - r)) / 2. So sets that aren't
    linked with the pivot are indexed by the first bound, and those that are by the second: a prefix of the differences
    that leaves out less than o of them, in pairs of one class; classes grow with the set (``schemes``) and not with the pivot, which may
    be far smaller, so that a class holds few tokens whatever the pivot. Where these don't suffice, single differences are keys as well, and where o may be 0 one key
    that all of them share. Rare additions come first, and commonest omissions.
    """
    (n, x, x_level), (n_pivot, p, p_level) = mine, pivot
    added, omitted = np.isin(x, p, assume_unique=True, invert=True), np.isin(p, x, assume_unique=True, invert=True)
    common = len(x) - int(added.sum())
    linked = bool(measure.holds(common, n, n_pivot))
    k, u = len(p), n_pivot - len(p)
    s = int(added.sum() + omitted.sum())
    e = s + n - len(x)
    r, one = measure.den - measure.num, measure.den + measure.num  # both times den + num
    if linked:
        least = (e * one - r * max(0, n - k) - u * (one - r)) // (2 * one) + 1
    else:
        least = -(-(e * one - r * (n + k)) // (one + r))
    if least > s:
        return linked, np.zeros(0, np.uint64)
    rank = np.concatenate((x_level[added].astype(np.int64), 128 - p_level[omitted].astype(np.int64)))
    found = np.concatenate((x[added], ~p[omitted]))
    found = found[np.lexsort((found, rank))]
    keys = [np.zeros(0, np.uint64)]
    for scheme in schemes(n, measure):
        salted = (salt + scheme * _K) % (1 << 64)
        bits = max(0, (2 * r * (1 << scheme) // (one * CLASS)).bit_length())
        pairs, missing = combined(found, s - max(least, 1) + 1, bits, 2, salted)
        keys.append(pairs)
        if missing > 0:
            keys.append(_mix(found + _U(salted)))
    if least <= 0:
        keys.append(_mix(np.array([salt], np.uint64)))
    keys = np.concatenate(keys)
    return linked, np.unique(keys)


HELD = "sid long, rid long, n long, weight double, tokens binary, levels binary, keys array<long>"


def candidates(parts: DataFrame, measure: Measure) -> DataFrame:
    """The sets whose prefixes need index entries: all tokens that other sets hold, in order, with levels, and the keys.

    ``weight`` is higher the commoner the tokens of a set are.
    """

    def run(group: pa.Table) -> pa.Table:
        about = group.filter(pa.compute.equal(group.column("kind"), DOCS))
        rest = group.filter(pa.compute.less(group.column("kind"), DOCS))
        rids, sids, sizes = (numbers(about.column(c), np.int64) for c in ("rids", "keys", "more"))
        owner, keys, level = numbers(rest.column("rids"), np.int64), numbers(rest.column("keys"), np.uint64), numbers(rest.column("more"), np.uint8)
        order = np.lexsort((keys, level, owner))
        owner, keys, level = owner[order], keys[order], level[order]
        by = np.argsort(rids)
        out = []
        for i in by:
            a, b = np.searchsorted(owner, (rids[i], rids[i] + 1))
            n = int(sizes[i])
            missing = measure.errors(n) + 1 - (n - (b - a))
            if missing > 0 and b > a:
                out.append((int(sids[i]), int(rids[i]), n, float(level[a:b].sum()) / n, keys[a:b].tobytes(), level[a:b].tobytes(), prefix_keys(keys[a:b], level[a:b], missing, n, measure).view(np.int64)))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        give_back()
        return pa.Table.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=[x.split()[0] for x in HELD.split(", ")])

    return parts.groupBy("part").applyInArrow(run, HELD)


# ---- verification and components


def sketch(found: np.ndarray) -> bytes:
    """How many tokens fall in each of 16 to 4096 classes of hashes (about four tokens each), 255 at most."""
    bits = min(12, max(4, (len(found) // 4).bit_length()))
    return np.minimum(np.bincount((_mix(found) >> _U(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def apart(a: bytes, b: bytes) -> int:
    """A lower bound on the number of tokens that only one of two sets has: what their sketches differ by."""
    x, y = np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.minimum(x.reshape(len(y), -1).sum(1), 255)
    return int(np.abs(x - y).sum())


def sketches_of(held: DataFrame) -> DataFrame:
    """(sid, k, sketch): how many tokens of a set other sets hold, and the sketch of those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "tokens"):
            found = [np.frombuffer(x, np.uint64) for x in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("sid"), pa.array([len(x) for x in found], pa.int64()), pa.array([sketch(x) for x in found], pa.binary())], names=["sid", "k", "sketch"])

    return held.select("sid", "tokens").mapInArrow(run, "sid long, k long, sketch binary")


PAIR = "a long, b long, n long, m long"


def _checked(pairs: DataFrame, sides: DataFrame, columns: list[str], holds) -> DataFrame:
    """The pairs (a, b, n, m) for which ``holds`` is true of both sides' columns."""
    first = sides.select(F.col("sid").alias("a"), *(F.col(c).alias(f"{c}_a") for c in columns))
    second = sides.select(F.col("sid").alias("b"), *(F.col(c).alias(f"{c}_b") for c in columns))
    names = [f"{c}_{side}" for side in "ab" for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, names[-1]):
            keep = [holds(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("n", "m", *names)), strict=True)]
            yield batch.select(["a", "b", "n", "m"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(first, "a").join(second, "b").select("a", "b", "n", "m", *names).mapInArrow(run, PAIR)


def verified(pairs: DataFrame, sketches: DataFrame, held: DataFrame, measure: Measure) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough: first by their sketches, then by the tokens themselves."""

    def may(n: int, m: int, k: int, x: bytes, j: int, y: bytes) -> bool:
        return measure.holds((k + j - apart(x, y)) // 2, n, m)

    def does(n: int, m: int, x: bytes, y: bytes) -> bool:
        u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        return measure.holds(len(np.intersect1d(u, v)), n, m)

    left = settle(_checked(pairs, sketches, ["k", "sketch"], may))
    out = settle(_checked(small(left, 64, BROADCAST_BYTES), held, ["tokens"], does).select("a", "b"))
    discard(left)
    return out


def once(rows: DataFrame) -> DataFrame:
    """The rows of one key for each set of members: keys that the same sets share bring the same sets together.

    Members are compared by their number and two independent 64-bit hashes; keys of a single member go.
    """
    mix = lambda seed: F.bit_xor(F.xxhash64("sid", F.lit(seed)))
    members = rows.groupBy("key").agg(F.count("*").alias("c"), mix(1).alias("x"), mix(2).alias("y")).where("c > 1")
    kept = settle(members.groupBy("c", "x", "y").agg(F.min("key").alias("key")).select("key"), rows.count())
    return settle(rows.join(small(kept, 32, BROADCAST_BYTES), "key"))


def differences(pairs: DataFrame, held: DataFrame, measure: Measure) -> DataFrame:
    """(a, b, n, weight, linked, keys): sets a with their pivots b, whether these are linked, and the keys of the differences.

    All sets of a pivot share one key if comparing each with each makes ``PAIRS_PER_ROW`` pairs of a set at most. Then
    the rows are as many as the sets, however many tokens these differ in and however the sets overlap.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ta"):
            linked, keys = [], []
            for b, few, n, m, *blobs in zip(*(batch.column(c).to_pylist() for c in ("b", "few", "n", "m", "ta", "la", "tb", "lb")), strict=True):
                x, x_level, p, p_level = (np.frombuffer(v, t) for v, t in zip(blobs, (np.uint64, np.uint8) * 2, strict=True))
                if few:
                    is_linked, found = bool(measure.holds(len(np.intersect1d(x, p)), n, m)), _mix(np.array([b % (1 << 64)], np.uint64))
                else:
                    is_linked, found = difference_keys((n, x, x_level), (m, p, p_level), b % (1 << 64), measure)
                linked.append(is_linked)
                keys.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "n", "weight")), pa.array(linked, pa.bool_()), pa.array(keys, pa.list_(pa.int64()))], names=["a", "b", "n", "weight", "linked", "keys"])

    first = held.select(F.col("sid").alias("a"), "n", "weight", F.col("tokens").alias("ta"), F.col("levels").alias("la"))
    second = held.select(F.col("sid").alias("b"), F.col("n").alias("m"), F.col("tokens").alias("tb"), F.col("levels").alias("lb"))
    crowds = settle(pairs.groupBy("b").agg((F.count("*") <= 2 * PAIRS_PER_ROW).alias("few")), pairs.count())
    told = pairs.join(small(crowds, 32, BROADCAST_BYTES), "b")
    joined = told.join(first, "a").join(second, "b").select("a", "b", "few", "n", "m", "weight", "ta", "la", "tb", "lb")
    return joined.mapInArrow(run, "a long, b long, n long, weight double, linked boolean, keys array<long>")


def parities_of(held: DataFrame) -> DataFrame:
    """(sid, k, bits): how many tokens of a set other sets hold, and for each of 64 ``LONGS`` classes of hashes whether an odd number of them is in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = 64 * LONGS
        for batch in slices(batches, "tokens"):
            found = [np.frombuffer(x, np.uint64) for x in batch.column("tokens").to_pylist()]
            bits = [np.packbits(np.bincount((_mix(x) % _U(classes)).astype(np.int64), minlength=classes) & 1).view("<i8") for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("sid"), pa.array([len(x) for x in found], pa.int64()), pa.array(bits, pa.list_(pa.int64()))], names=["sid", "k", "bits"])

    return held.select("sid", "tokens").mapInArrow(run, "sid long, k long, bits array<long>")


def blocks_of() -> Column:
    """How many blocks the members (``c``) of a key are dealt to."""
    return F.ceil(F.col("c") / BLOCK).cast("int")


def placed_twice(rows: DataFrame) -> DataFrame:
    """``rows`` at the places where the greater set of a pair meets lesser ones: its class of sizes and the one below, in all blocks of the key."""
    at = F.explode(F.sequence(F.lit(0), 2 * blocks_of() - 1))
    return rows.withColumn("at", at).withColumns({"size": F.col("size") - F.col("at") % 2, "block": F.floor(F.col("at") / 2).cast("int")})


def near_pairs(rows: DataFrame, held: DataFrame, measure: Measure) -> DataFrame:
    """(a, b, n, m): sets of different components (``comp``) that share a key, have alike sizes, and may be linked by their parities.

    ``rows`` has (key, sid, n, comp, c), c being the members of the key. Members meet by classes of sizes, so that three rows
    are made of one, whatever the key holds; only a key of more than ``BLOCK`` members is dealt out in blocks as well. Each token that only one of two sets has changes
    one parity, so as many bits as differ, and the tokens that no other set holds, are a lower bound on what they differ by.
    """
    # a little wider than linked sets' sizes can differ, so that rounding can't part them by two classes
    wide = math.log(1.001 * measure.den / measure.num)
    bits = settle(parities_of(held))
    told = rows.join(small(bits, 100 + 8 * LONGS, BROADCAST_BYTES), "sid").withColumn("own", F.col("n") - F.col("k")).withColumn("size", F.floor(F.ln("n") / wide).cast("int"))
    side = lambda df, x: df.select("key", "size", "block", *[F.col(c).alias(f"{c}_{x}") for c in ("sid", "n", "comp", "own")], *[F.col("bits")[i].alias(f"bits_{x}{i}") for i in range(LONGS)])
    x, y = side(told.withColumn("block", F.pmod(F.xxhash64("sid"), blocks_of()).cast("int")), "x"), side(placed_twice(told), "y")
    n, m = F.col("n_x"), F.col("n_y")
    once_ = ((n < m) | ((n == m) & (F.col("sid_x") < F.col("sid_y")))) & (F.col("comp_x") != F.col("comp_y"))
    alike = n * measure.den >= m * measure.num
    differ = F.col("own_x") + F.col("own_y")
    for i in range(LONGS):
        differ = differ + F.bit_count(F.col(f"bits_x{i}").bitwiseXOR(F.col(f"bits_y{i}")))
    near = differ * (measure.den + measure.num) <= (n + m) * (measure.den - measure.num)
    x, y = x.alias("x"), y.alias("y")
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.size") == F.col("y.size")) & (F.col("x.block") == F.col("y.block"))
    met = x.join(y, same & once_ & alike & near)
    one, two = (F.struct(F.col(f"sid_{s}").alias("a"), F.col(f"n_{s}").alias("n")) for s in "xy")
    pair = met.select(F.least(one, two).alias("one"), F.greatest(one, two).alias("two")).distinct()
    return pair.select("one.a", F.col("two.a").alias("b"), "one.n", F.col("two.n").alias("m"))


def links(held: DataFrame, measure: Measure) -> DataFrame:
    """Verified pairs (a, b) of set ids that join all that is linked into components.

    Pivots are taken anew while pairs are many and at least halved by them, so the rounds are a logarithm of the pairs at most.
    """
    keyed = held.select(F.explode("keys").alias("key"), "sid", "n", "weight")
    found = labels = left = None
    while True:
        rows = once(settle(keyed))
        most = rows.count()
        if labels is not None:
            # keys whose members are of one component are done
            rows = settle(rows.join(small(labels, 48, BROADCAST_BYTES), "sid", "left").withColumn("comp", F.coalesce("component", "sid")).drop("component"))
            sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("own"))
            sizes = settle(sizes.select("key", "c", ((F.col("c") * F.col("c") - F.col("own")) / 2).alias("pairs")).where("pairs > 0"), most)
            pairs_left, rows_left = (x or 0 for x in sizes.agg(F.sum("pairs"), F.sum("c")).first())
            if pairs_left <= PAIRS_PER_ROW * rows_left or (left is not None and pairs_left > left / 2):
                break
            left = pairs_left
            rows = settle(rows.join(small(sizes.select("key"), 32, BROADCAST_BYTES), "key", "left_semi"))
        pivots = rows.groupBy("key").agg(F.max_by("sid", F.struct("weight", "sid")).alias("b"))
        pairs = settle(rows.join(small(settle(pivots, most), 48, BROADCAST_BYTES), "key").where("sid <> b").select(F.col("sid").alias("a"), "b").distinct(), most)
        met = settle(differences(pairs, held, measure))
        more = met.where("linked").select("a", "b")
        found = more if found is None else found.unionByName(more)
        labels = stars(found).withColumnRenamed("node", "sid")
        # where all of a pivot's sets are linked with it, nothing is left to find
        open_ = settle(met.where("not linked").select("b").distinct(), pairs.count())
        keyed = met.join(small(open_, 32, BROADCAST_BYTES), "b", "left_semi").select(F.explode("keys").alias("key"), F.col("a").alias("sid"), "n", "weight")
    rest = near_pairs(rows.join(small(sizes.select("key", "c"), 48, BROADCAST_BYTES), "key"), held, measure)
    return found.unionByName(verified(rest, settle(sketches_of(held)), held, measure))


def linked(docs: DataFrame, every: DataFrame, seed: int, measure: Measure) -> DataFrame:
    """(sid, component) of the sets that are linked with one of a lesser id, directly or not."""
    total = every.agg(F.sum("n")).first()[0] or 0
    bits = max(LEAST_BITS, (total // RANGE_TOKENS).bit_length())
    parts = shared_tokens(dealt(docs, measure.words, seed, bits, hot(every)), bits)
    found = settle(candidates(parts, measure))
    # equal sets that several tasks have met
    first = settle(found.groupBy("sid").agg(F.min("rid").alias("rid")))
    held = settle(found.join(small(first, 48, BROADCAST_BYTES), ["sid", "rid"], "left_semi"))
    discard(found)
    comps = stars(links(held, measure))
    discard(held)
    return comps.withColumnRenamed("node", "sid")


def grouped(docs: DataFrame, measure: Measure) -> tuple[DataFrame, int]:
    """(doc_id, n_shingles, sid, component_id) for every row of ``docs``, and the seed of the set ids."""
    every, seed = plain_sets(docs, measure.words)
    comps = linked(docs, every, seed, measure)
    placed = settle(every.join(small(comps, 48, BROADCAST_BYTES), "sid", "left").select("doc_id", F.col("n").alias("n_shingles"), "sid", F.coalesce("component", "sid").alias("comp")))
    # only sets that several rows have, and linked ones, take their id from another row
    least = settle(placed.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).where("rows > 1").drop("rows"), placed.count())
    told = placed.join(small(least, 48, BROADCAST_BYTES), "comp", "left")
    alone = F.col("comp").isNull() | F.col("least").isNull()
    return told.select("doc_id", "n_shingles", "sid", F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id")), seed


def one_of_each(docs: DataFrame, measure: Measure) -> DataFrame:
    """``docs`` with one document of each component, the one with the least id.

    Rows that repeat both the id and the set of a document that goes, go too; those that repeat one that stays, stay.
    """
    told, seed = grouped(docs, measure)
    gone = settle(told.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").agg(F.collect_set("sid").alias("gone")))
    words = measure.words

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            stays = [sids is None or set_id(tokens(text, words), seed)[0] not in sids for text, sids in zip(text_bytes(batch), batch.column("gone").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_struct_array(batch.column("row").filter(pa.array(stays, pa.bool_())))

    out = small(gone.select(F.col("doc_id").alias("gone_id"), "gone"), 80, BROADCAST_BYTES)
    row = F.struct(*docs.columns).alias("row")
    joined = docs.select(row, "doc_id", "text").join(out, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left").select("row", "text", "gone")
    return joined.mapInArrow(keep, docs.schema)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alone(lambda: grouped(table(spark, sf_dir, "documents"), Measure(3, 90))[0].select("doc_id", "n_shingles", "component_id"))


QUERIES = {"op9_ngram_join": op9_ngram_join}
ORACLE_SQL = {
    "op9_ngram_join": r"""
        WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
             s AS (SELECT DISTINCT r, array_to_string(ws[i : i + 2], ' ') AS g FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
             n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
             p AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
             l AS (SELECT a, b FROM p JOIN n x ON a = x.r JOIN n y ON b = y.r WHERE 100 * k >= 90 * (x.n + y.n - k)),
             e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
             t AS (SELECT r AS a, r AS b FROM w UNION SELECT t.a, e.b FROM t JOIN e ON t.b = e.a)
        SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
        FROM w LEFT JOIN n ON w.r = n.r JOIN (SELECT t.a, min(v.doc_id) AS component_id FROM t JOIN w v ON t.b = v.r GROUP BY t.a) c ON c.a = w.r"""
}
