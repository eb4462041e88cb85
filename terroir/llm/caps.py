"""Near duplicates among embeddings by spherical-cap filters.

A filter is a direction; a vector passes it if their cosine exceeds a threshold, that is if the vector lies in the
filter's cap. Directions are structured: after a random rotation the space is cut in ``PARTS`` blocks, each block has its
own random unit codes, and every combination of codes is a direction, so a few hundred codes give millions of directions.
A vector lists all directions it exceeds without trying them: block by block, from the highest products down, it only
extends combinations that the best codes of the blocks to come can still lift over the threshold. Two vectors that
are near each other share a cap with high probability, unrelated ones hardly ever; all is done in ``TABLES`` rotations.

The number of codes grows with the rows of the largest label, so that random vectors of it meet about ``RANDOM`` times
for each vector; beyond ``MOST_CODES`` random meetings grow with the rows instead. The threshold is fitted to random
directions, not to data, so that a vector passes about ``PASSES`` filters in each table.

Vectors join on filters. Where more than ``HOT`` share one, the filter first gets a pivot, and every vector within half
the angle of the similarity of a pivot is at home in that pivot's ball. All vectors of a ball are linked for certain, so a
crowd of copies is counted, not paired. What is joined then are the balls (nearly all hold one vector), in blocks where a
filter still has many. Two balls whose centres and radii settle it are linked or not as wholes; else the vectors of
one are held against the other ball, and only where that doesn't settle it either, against its vectors. Links between
single vectors are decided by their cosine in double precision, never by an angle.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components, or whose label is null, is
linked with nothing: n_links 0, its own component, kept. Vectors with different numbers of components aren't
compared. Rows are told apart even where ids repeat or are null; a component's id is its least id that isn't null, and a
null id is kept only if nothing else is in its component. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alone, discard, give_back, settle, table
from .components import components

#: Rotations, blocks of a direction, and filters that a vector passes in each rotation on average.
TABLES, PARTS, PASSES = 3, 3, 12
#: Filters of a rotation that every vector is put under, even if it doesn't exceed the threshold of so many.
FEWEST = 10
#: Codes of a block, and how many unrelated vectors of its label a vector meets on average.
LEAST_CODES, MOST_CODES, RANDOM = 16, 1024, 1
#: Vectors with fewer components than this get zeros, so that random directions are spread alike.
LEAST_DIMS = 24
#: Vectors that share a filter before it gets a pivot; also the rows of a block when its balls are paired.
HOT = 16
#: Vectors that are decoded at once in a task.
VECTORS = 1024
#: Angles this near to a bound don't settle anything.
MARGIN = 1e-6


class Filters:
    """The directions of all tables for vectors of ``dims`` components."""

    def __init__(self, dims: int, codes: int):
        rng = np.random.default_rng([dims, codes])
        self.dims, self.codes, wide = dims, codes, max(dims, LEAST_DIMS)
        self.cuts = [len(x) for x in np.array_split(np.arange(wide), PARTS)]
        self.rotations = [np.linalg.qr(rng.standard_normal((wide, wide)))[0][:dims] for _ in range(TABLES)]
        self.blocks = [[self._units(rng, codes, n) / math.sqrt(PARTS) for n in self.cuts] for _ in range(TABLES)]
        self.threshold = 0.0
        sample = self._units(rng, 256, wide)
        low, high = 0.0, 1.0
        for _ in range(20):  # the share of directions in a cap falls with the threshold
            middle = (low + high) / 2
            many = self._decoded(sample, self.blocks[0], np.full(len(sample), middle), most=PASSES * len(sample)) is None
            low, high = (middle, high) if many else (low, middle)
        self.threshold = high

    @staticmethod
    def _units(rng: np.random.Generator, n: int, dims: int) -> np.ndarray:
        x = rng.standard_normal((n, dims))
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def _decoded(self, x: np.ndarray, blocks: list[np.ndarray], threshold: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """(row, direction, cosine) of every direction that a row of ``x`` exceeds by its own ``threshold``; None if they are more than ``most``."""
        n, start, products, orders = len(x), 0, [], []
        for codes, width in zip(blocks, self.cuts, strict=True):
            p = x[:, start : start + width] @ codes.T
            start += width
            order = np.argsort(-p, axis=1)
            orders.append(order)
            products.append(np.take_along_axis(p, order, axis=1))
        rest = np.cumsum([np.zeros(n), *(p[:, 0] for p in products[:0:-1])], axis=0)[::-1]  # the best that later blocks can add
        rows, number, total = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
        for p, order, more in zip(products, orders, rest, strict=True):
            # the sorted products of all rows as one rising sequence: one search finds how many codes of a row are enough
            need = np.clip(threshold[rows] - more[rows] - total, -2, 2)
            count = np.searchsorted((8.0 * np.arange(n)[:, None] - p).ravel(), 8.0 * rows - need, side="right") - rows * self.codes
            # each combination so far leads to one direction at least
            if most is not None and count.sum() > most:
                return None
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            number, total, rows = np.repeat(number, count), np.repeat(total, count), np.repeat(rows, count)
            number, total = number * self.codes + order[rows, place], total + p[rows, place]
        return rows, number, total

    def _passed(self, x: np.ndarray, blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction): all directions exceeded; for a row that exceeds fewer than ``FEWEST``, that many nearest ones."""
        rows, number, _ = self._decoded(x, blocks, np.full(len(x), self.threshold))
        short, bound = np.flatnonzero(np.bincount(rows, minlength=len(x)) < FEWEST), self.threshold
        kept = ~np.isin(rows, short)
        out = [(rows[kept], number[kept])]
        while len(short):
            bound -= 0.02
            rows, number, total = self._decoded(x[short], blocks, np.full(len(short), bound))
            order = np.lexsort((number, -total, rows))
            rows, number = rows[order], number[order]
            counts = np.bincount(rows, minlength=len(short))
            near = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) < FEWEST
            near &= np.repeat(counts >= min(FEWEST, self.codes**PARTS), counts)
            out.append((short[rows[near]], number[near]))
            short = short[counts < min(FEWEST, self.codes**PARTS)]
        return np.concatenate([r for r, _ in out]), np.concatenate([c for _, c in out])

    def decoded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter that the unit vectors ``x`` pass, in all tables."""
        found = [self._passed(x @ r, b) for r, b in zip(self.rotations, self.blocks, strict=True)]
        return np.concatenate([rows for rows, _ in found]), np.concatenate([t * self.codes**PARTS + number for t, (_, number) in enumerate(found)])


@cache
def _filters(dims: int, codes: int) -> Filters:
    return Filters(dims, codes)


def codes_for(rows: int) -> int:
    """Codes of a block, so that random vectors of a label with so many rows meet about ``RANDOM`` others each."""
    return min(MOST_CODES, max(LEAST_CODES, math.ceil((TABLES * PASSES**2 * rows / RANDOM) ** (1 / PARTS))))


def packed(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(rid, vec_id, label, v) of every row, written; ``v`` has the components as 64-bit floats, null where they aren't to be compared."""
    x = F.col(vector).cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    usable = F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", finite) & F.exists("v", lambda c: c != 0)
    named = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(label).alias("label"), x.alias("v"))
    kind = named.schema["label"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            lengths = np.diff(v.offsets.to_numpy()) if len(v) else np.zeros(0, np.int64)
            flat = v.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(np.where(v.is_valid().to_numpy(zero_copy_only=False), lengths, 0))])
            valid = pa.array(v.is_valid()).buffers()[1]
            made = pa.Array.from_buffers(pa.binary(), len(v), [valid, pa.py_buffer((8 * ends).astype(np.int32)), pa.py_buffer(flat.astype("<f8").tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), made], names=["vec_id", "label", "v"])

    plain = named.withColumn("v", F.when(usable, F.col("v"))).mapInArrow(pack, f"vec_id long, label {kind}, v binary")
    return settle(plain.withColumn("rid", F.monotonically_increasing_id()))


def _units(column: pa.Array, dims: int) -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dims)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small numbers stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def filter_rows(rows: DataFrame, codes: int) -> DataFrame:
    """(key, rid): every filter of each vector, hashed together with its label and number of components."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(batch.column("size").to_pylist(), np.int64)
            for size in np.unique(sizes).tolist():
                same = batch.filter(pa.array(sizes == size))
                for at in range(0, same.num_rows, VECTORS):
                    part = same.slice(at, VECTORS)
                    found, numbers = _filters(size // 8, codes).decoded(_units(part.column("v"), size // 8))
                    took = pa.array(found)
                    yield pa.RecordBatch.from_arrays([part.column(c).take(took) for c in ("rid", "label", "size")] + [pa.array(numbers)], names=["rid", "label", "size", "number"])
        give_back()

    kind = rows.schema["label"].dataType.simpleString()
    each = rows.select("rid", "label", F.octet_length("v").alias("size"), "v").mapInArrow(decode, f"rid long, label {kind}, size int, number long")
    return each.select(F.xxhash64("label", "size", "number").alias("key"), "rid")


def with_cosine(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """``pairs`` (a, b and other columns) of vectors with one label and size, with the ``cosine`` of the two."""
    names = pairs.columns
    side = lambda n: rows.select(F.col("rid").alias(n), F.col("label").alias(f"label_{n}"), F.col("v").alias(f"v_{n}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").where((F.col("label_a") == F.col("label_b")) & (F.octet_length("v_a") == F.octet_length("v_b")))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column("v_a").to_pylist()], np.int64)
            for size in np.unique(sizes).tolist():
                same = batch.filter(pa.array(sizes == size))
                cosine = (_units(same.column("v_a"), size // 8) * _units(same.column("v_b"), size // 8)).sum(1)
                yield pa.RecordBatch.from_arrays([*(same.column(c) for c in names), pa.array(cosine)], names=[*names, "cosine"])
        give_back()

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema)
    return met.select(*names, "v_a", "v_b").mapInArrow(measure, f"{kinds}, cosine double")


def _angle() -> Column:
    return F.acos(F.greatest(F.least("cosine", F.lit(1.0)), F.lit(-1.0)))


def _paired(members: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of ``member`` under each ``key``, once. A key with many is cut in blocks that meet two by two in tasks of their own."""
    counts = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / HOT).cast("int")).drop("n")
    dealt = members.join(counts, "key").withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cells = dealt.select("key", "member", "block", other).select("key", "member", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    one = cells.where("block = low").select("key", "low", "high", F.col("member").alias("a"))
    two = cells.where("block = high").select("key", "low", "high", F.col("member").alias("b"))
    met = one.join(two, ["key", "low", "high"]).where((F.col("a") < F.col("b")) | (F.col("low") < F.col("high"))).where("a <> b")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(rows: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(rid, n_links) and (a, b): how many others each vector is linked with, and edges that connect what is linked.

    Vectors without any link may be missing from both.
    """
    known = rows.where("v is not null").select("rid", "label", "v")
    most = known.groupBy("label", F.octet_length("v")).count().agg(F.max("count")).first()[0] or 0
    wide = math.acos(least)
    filters = settle(filter_rows(known, codes_for(most)))
    pivots = filters.groupBy("key").agg(F.count("*").alias("n"), F.min("rid").alias("pivot")).where("n > 1")
    shared = settle(filters.join(pivots, "key"))
    discard(filters)

    near = with_cosine(shared.where((F.col("n") > HOT) & (F.col("rid") != F.col("pivot"))).select(F.col("rid").alias("a"), F.col("pivot").alias("b")).distinct(), known)
    home = near.withColumn("away", _angle()).where(F.col("away") <= wide / 2 - MARGIN).groupBy("a").agg(F.min(F.struct("b", "away")).alias("h"))
    placed = shared.select("rid").distinct().join(home.withColumnRenamed("a", "rid"), "rid", "left")
    placed = settle(placed.select("rid", F.coalesce("h.b", "rid").alias("ball"), F.coalesce("h.away", F.lit(0.0)).alias("away")))
    balls = settle(placed.groupBy("ball").agg(F.count("*").alias("size"), F.max("away").alias("radius"), F.min("rid").alias("head")))

    members = shared.join(placed.select("rid", "ball"), "rid").select("key", F.col("ball").alias("member")).distinct()
    pairs = with_cosine(_paired(settle(members)), known)
    side = lambda n: balls.select(F.col("ball").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in ("size", "radius", "head")])
    exact = (F.col("radius_a") == 0) & (F.col("radius_b") == 0)
    reach = F.col("radius_a") + F.col("radius_b")
    sure = F.when(exact, F.col("cosine") >= least).when(_angle() + reach <= wide - MARGIN, True).when(_angle() - reach > wide + MARGIN, False)
    judged = settle(pairs.join(side("a"), "a").join(side("b"), "b").withColumn("linked", sure).where("linked is null or linked"))
    whole = judged.where("linked")

    # the vectors of ball a against ball b, then against its vectors
    apart = placed.select(F.col("ball").alias("a"), F.col("rid").alias("x"))
    open_ = judged.where("linked is null").select("a", "b").join(apart, "a").select(F.col("x").alias("a"), "b")
    met = with_cosine(open_, known).join(side("b"), "b")
    settled = F.when(F.col("radius_b") == 0, F.col("cosine") >= least).when(_angle() + F.col("radius_b") <= wide - MARGIN, True).when(_angle() - F.col("radius_b") > wide + MARGIN, False)
    one_by_ball = settle(met.withColumn("linked", settled).where("linked is null or linked"))
    half = one_by_ball.where("linked")
    singles = one_by_ball.where("linked is null").select("a", "b").join(placed.select(F.col("ball").alias("b"), F.col("rid").alias("y")), "b").select("a", F.col("y").alias("b"))
    single = settle(with_cosine(singles, known).where(F.col("cosine") >= least).select("a", "b"))

    by_ball = balls.select("ball", (F.col("size") - 1).alias("n"))
    for x, y in (("a", "b"), ("b", "a")):
        by_ball = by_ball.unionByName(whole.select(F.col(x).alias("ball"), F.col(f"size_{y}").alias("n")))
    by_ball = by_ball.unionByName(half.select(F.col("b").alias("ball"), F.lit(1).cast("long").alias("n"))).groupBy("ball").agg(F.sum("n").alias("n"))
    counts = placed.join(by_ball, "ball").select("rid", "n").unionByName(half.select(F.col("a").alias("rid"), F.col("size_b").alias("n")))
    for x in ("a", "b"):
        counts = counts.unionByName(single.select(F.col(x).alias("rid"), F.lit(1).cast("long").alias("n")))
    counts = counts.groupBy("rid").agg(F.sum("n").alias("n_links")).where("n_links > 0")

    edges = placed.join(balls.where("size > 1").select("ball", "head"), "ball").where("rid <> head").select(F.col("rid").alias("a"), F.col("head").alias("b"))
    edges = edges.unionByName(whole.select(F.col("head_a").alias("a"), F.col("head_b").alias("b"))).unionByName(half.select("a", F.col("head_b").alias("b"))).unionByName(single)
    return counts, edges


def near_duplicates(vectors: DataFrame, least: float = 0.93, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per row (vec_id, n_links, component_id, kept): rows of one label are linked from a cosine of ``least`` on."""
    rows = packed(vectors, id, vector, label)
    counts, edges = (settle(x) for x in links(rows, least))
    placed = settle(components(edges).join(rows.select(F.col("rid").alias("node"), "vec_id"), "node"))
    least_id = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = placed.join(least_id, "component").select(F.col("node").alias("rid"), "component_id")
    out = rows.select("rid", "vec_id").join(counts, "rid", "left").join(named, "rid", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alone(lambda: near_duplicates(table(spark, sf_dir, "embeddings")))


QUERIES = {"op13_embedding_near_dedup": op13_embedding_near_dedup}
ORACLE_SQL = {
    "op13_embedding_near_dedup": """
        WITH RECURSIVE v AS (
               SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
               WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
             linked AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
             reached AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reached r JOIN linked l ON r.other = l.a),
             least AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY 1)
        SELECT e.vec_id, (SELECT count(*) FROM linked l WHERE l.a = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept FROM embeddings e JOIN least USING (vec_id)"""
}
