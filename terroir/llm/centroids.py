"""Centroid clustering of whole-number vectors with a Walsh-Hadamard progressive search.

Vectors of a fixed power of two of components are scaled and rounded down to integers. The Walsh-Hadamard
transform of an integer vector is integer too, and squared distances of transforms are exactly ``dims`` times those of
the vectors. Ordered by sequency, a few coarse coefficients carry much of a difference. So the search adds up squared differences
coefficient block by block, coarse to fine. The centroid that is nearest after the first block is finished first; its
whole distance is the bound beyond which another centroid is strictly worse and dropped. What is never dropped is
finished to the last coefficient, so distances and ties are exact.

Each round is one pass: tasks assign their vectors and hand on the sums of each cluster, one row for each cluster and task.
The driver holds the centroids alone (k times ``dims`` numbers). The vectors are packed once into a written table.

Defined results: vectors that are null, don't have ``dims`` components, hold null or non-finite ones, or any that scaled
goes beyond 2**24 either way (its distances may not fit 64 bits) are left out. Repeated ids and repeated vectors count
row by row; as starting centroids, rows of one id are told apart by their components. A null id is hashed as the empty
string. Fewer vectors than ``k`` give that many centroids, an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, give_back, settle, table

#: Vectors that are searched at once in a task.
VECTORS = 4096
#: Scaled components stay within this.
LARGEST = 1 << 24
#: Ends of the coefficient blocks, in shares of all coefficients.
BLOCKS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1)


def _sequency(dims: int) -> np.ndarray:
    """The rows of the Hadamard matrix, as ``transform`` numbers them, by their number of sign changes."""
    rows = transform(np.eye(dims, dtype=np.int64)).T
    return np.argsort((np.diff(np.sign(rows), axis=1) != 0).sum(1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, exact in integers."""
    n, dims = x.shape
    step = 1
    while step < dims:
        pairs = x.reshape(n, dims // (2 * step), 2, step)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, dims)
        step *= 2
    return x


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row (the smaller number among equals) and the squared distance."""
    (n, dims), k = x.shape, len(centroids)
    order = _sequency(dims)
    a, b = transform(x)[:, order], transform(centroids)[:, order]
    ends = sorted({max(1, round(dims * share)) for share in BLOCKS})

    first = ends[0]
    partial = np.stack([((a[:, :first] - c[:first]) ** 2).sum(1) for c in b], axis=1)
    leader = partial.argmin(1)
    bound = ((a - b[leader]) ** 2).sum(1)
    rows, numbers = np.nonzero(partial <= bound[:, None])
    sums = partial[rows, numbers]
    for start, end in zip(ends, ends[1:], strict=False):
        sums = sums + ((a[rows, start:end] - b[numbers, start:end]) ** 2).sum(1)
        alive = sums <= bound[rows]
        rows, numbers, sums = rows[alive], numbers[alive], sums[alive]
    best = np.lexsort((numbers, sums, rows))
    best = best[np.unique(rows[best], return_index=True)[1]]  # every row's leader is alive, so each has one
    return numbers[best], sums[best] // dims


def packed(vectors: DataFrame, dims: int = 64, scale: int = 64, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that count, as little-endian 32-bit integers, written."""
    x = F.col(vector)
    good = lambda c: c.isNotNull() & ~F.isnan(c) & (c * scale).between(-LARGEST, LARGEST)
    kept = vectors.select(F.col(id).cast("long").alias("vec_id"), x.cast("array<double>").alias("v")).where(F.col("v").isNotNull() & (F.size("v") == dims) & F.forall("v", good))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.floor(scale * batch.column("v").flatten().to_numpy(zero_copy_only=False)).astype("<i4")
            ends = pa.py_buffer((np.arange(batch.num_rows + 1) * 4 * dims).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(whole.tobytes())])], names=["vec_id", "v"])

    return settle(kept.mapInArrow(pack, "vec_id long, v binary"))


def _whole(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def starts(rows: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The vectors of the ``k`` least hashes of seed and id."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    found = rows.select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([np.frombuffer(bytes(r.v), "<i4") for r in found], np.int64).reshape(-1, dims)


def updated(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the mean of each cluster, rounded down; empty clusters keep theirs."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS):
                x = _whole(batch.column("v").slice(at, VECTORS), dims)
                near = nearest(x, centroids)[0]
                np.add.at(sums, near, x)
                counts += np.bincount(near, minlength=k)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int64()), pa.array(counts), pa.array(sums.tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])
        give_back()

    each = rows.select("v").mapInArrow(add, "cluster long, n long, sums array<long>")
    total = each.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dims)]).alias("sums"))
    out = centroids.copy()
    for row in total.collect():
        if row.n:
            out[row.cluster] = [s // row.n for s in row.sums]
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    dims = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS):
                part = batch.slice(at, VECTORS)
                near, far = nearest(_whole(part.column("v"), dims), centroids)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(near.astype(np.int32)), pa.array(far)], names=["vec_id", "cluster", "distance"])
        give_back()

    return rows.mapInArrow(assign, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, dims: int = 64, scale: int = 64) -> DataFrame:
    """Per vector its cluster and squared distance, the sums of them, and a digest of the cluster's centroid."""
    spark = vectors.sparkSession
    rows = packed(vectors, dims, scale)
    centroids = starts(rows, k, seed, dims)
    names = "cluster int, centroid_sha256 string, cluster_inertia long, inertia long"
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id long, distance long, {names}")
    for _ in range(rounds):
        centroids = updated(rows, centroids)
    out = settle(assigned(rows, centroids))
    discard(rows)
    inertia = {r.cluster: r.d for r in out.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digest = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    described = spark.createDataFrame([(n, digest(c), inertia.get(n, 0), sum(inertia.values())) for n, c in enumerate(centroids)], names)
    return out.join(F.broadcast(described), "cluster")  # k rows


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings")).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _round(n: int) -> str:
    """The assignment to the centroids c{n}, as common table expressions."""
    return f"""
             d{n} AS (SELECT x.vec_id, c.cluster, sum((x.v - c.v) * (x.v - c.v)) AS distance FROM x JOIN c{n} c ON x.pos = c.pos GROUP BY ALL),
             a{n} AS (SELECT vec_id, cluster, distance FROM d{n} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)"""


def _means(n: int) -> str:
    return f"""
             m{n} AS (SELECT cluster, pos, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v FROM a{n} JOIN x USING (vec_id) GROUP BY ALL),
             c{n + 1} AS (SELECT c.cluster, c.pos, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m ON c.cluster = m.cluster AND c.pos = m.pos)"""


QUERIES = {"op12_centroid_clustering": op12_centroid_clustering}
ORACLE_SQL = {
    "op12_centroid_clustering": """
        WITH k AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
             x AS (SELECT vec_id, unnest(range(64)) AS pos, CAST(floor(64 * unnest(embedding)::DOUBLE) AS BIGINT) AS v FROM k),
             s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM k QUALIFY cluster < 16),
             c0 AS (SELECT cluster, pos, v FROM s JOIN x USING (vec_id)),"""
    + ",".join(_round(n) + "," + _means(n) for n in range(3))
    + ","
    + _round(3)
    + """
        SELECT vec_id, CAST(a3.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY a3.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM a3 JOIN (SELECT cluster, sha256(string_agg(v, ',' ORDER BY pos)) AS centroid_sha256 FROM c3 GROUP BY 1) h ON a3.cluster = h.cluster"""
}
