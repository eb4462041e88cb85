"""Importance resampling, centroid clustering and spherical-cap near-dedup against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from terroir.llm import caps, centroids, importance


def plain_sample(docs, target, words=1, percent=10):
    alphabet = set("abcdefghijklmnopqrstuvwxyz0123456789")

    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = "".join(c if c in alphabet or ord(c) > 127 else " " for c in low).split(" ")
        found = [w for w in found if w]
        return found, [zlib.crc32(" ".join(found[i : i + n]).encode()) % 10_000 for n in range(1, words + 1) for i in range(len(found) - n + 1)]

    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [text for _, text in docs]), (t, target)):
        for text in texts:
            for b in features(text)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    rows, able = [], []
    for i, text in docs:
        found, at = features(text)
        weight = math.floor(sum(gain[b] for b in at) / len(at)) if at else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(at), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
        if len(found) >= 20:
            able.append((-rows[-1][3], i is None, i or 0, -len(at), len(rows) - 1))
    ranks = {row: n + 1 for n, (*_, row) in enumerate(sorted(able)[: percent * len(able) // 100])}
    return sorted((str((*r, ranks.get(n))) for n, r in enumerate(rows)))


@pytest.mark.parametrize(("words", "percent"), [(1, 10), (3, 35), (2, 100), (1, 0)])
def test_resampling_equals_plain_python(spark, words, percent):
    rng = random.Random(4)
    vocabulary = ["Alpha", "beta", "GAMMA7", "δέλτα", "e-f", "x_y", "ß", "1.5", "日本"]
    docs = [(i, rng.choice([" ", "\n", " ", "\t "]).join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, "word " * 50_000), (5, docs[5][1]), (5, "other " * 30), (None, "alpha beta " * 20)] + [(7, "same row " * 15)] * 40
    target = ["alpha beta gamma7", None, "δέλτα δέλτα"]
    df = spark.createDataFrame([(*d, 0.5, 1) for d in docs], "doc_id long, text string, score double, rank int").repartition(3)
    bench = spark.createDataFrame([(1, t) for t in target], "item_id long, text string")
    got = importance.resample(df, bench, importance.Sampling(words=words, percent=percent))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_sample(docs, target, words, percent)


def test_resampling_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(none, none.select("text")).count() == 0
    one = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert importance.resample(one, none.select("text"), importance.Sampling(percent=100)).first().rank == 1


def plain_clusters(vectors, k=16, rounds=3, dims=64):
    kept = [(i, [math.floor(64 * float(c)) for c in v]) for i, v in vectors if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    cs = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cs = [[sum(col) // len(groups[n]) for col in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(cs)]
    last = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = {n: sum(d for _, m, d in last if m == n) for n in range(k)}
    return sorted(str((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest())) for i, n, d in last)


def test_clustering_equals_plain_python(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), (rng.standard_normal(64) * 10 ** rng.uniform(-3, 3)).tolist()) for i in range(150)]
    rows += [(150, rows[3][1]), (151, rows[3][1]), (151, rows[4][1]), (None, rows[5][1]), (152, [0.0] * 64), (153, [-0.001] * 64)]
    odd = [(160, None), (161, []), (162, [1.0] * 63), (163, [1.0] * 65), (164, [1.0] * 63 + [None]), (165, [float("nan")] + [1.0] * 63), (166, [float("-inf")] + [1.0] * 63)]
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<double>, cluster string").repartition(3)
    got = centroids.clustered(df).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_clusters(rows)
    assert centroids.clustered(df.limit(0)).count() == 0
    few = centroids.clustered(df.where("vec_id < 5")).select("vec_id", "cluster", "distance").collect()
    assert sorted(r.cluster for r in few) == [0, 1, 2, 3, 4] and not any(r.distance for r in few)


def test_progressive_search_is_exact():
    rng = np.random.default_rng(2)
    assert (centroids.transform(np.eye(8, dtype=np.int64)) @ centroids.transform(np.eye(8, dtype=np.int64)) == 8 * np.eye(8)).all()
    for size in (1, 3, 100, 1 << 24):
        x, c = rng.integers(-size, size + 1, (300, 64)), rng.integers(-size, size + 1, (16, 64))
        c[9] = c[4]
        far = ((x[:, None] - c) ** 2).sum(2)
        near, distance = centroids.nearest(x, c)
        assert (near == far.argmin(1)).all() and (distance == far.min(1)).all()


def plain_links(rows, least=0.93):
    """(vec_id, n_links) by comparing all pairs, and the pairs."""
    unit = {n: np.array(v, float) / np.linalg.norm(np.array(v, float)) for n, (_, v, label) in enumerate(rows) if label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    pairs = [(a, b) for a in unit for b in unit if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least]
    return [sum(n in p for p in pairs) for n in range(len(rows))], pairs


def around(rng, base, cosine):
    y = rng.standard_normal(len(base))
    y -= (y @ base) * base
    return cosine * base + math.sqrt(1 - cosine**2) * y / np.linalg.norm(y)


def planted(seed=1, dims=64):
    """Vectors of two labels: pairs at 0.94 and more, a crowd of near copies, copies, chains, and a wide crowd that balls can't settle."""
    rng, rows = np.random.default_rng(seed), []
    unit = lambda: (lambda x: x / np.linalg.norm(x))(rng.standard_normal(dims))
    for label in (0, 1):
        for _ in range(60):
            base = unit()
            rows += [(base * rng.uniform(0.1, 50), label), (around(rng, base, rng.uniform(0.94, 0.999)), label)]
        crowd = unit()
        rows += [(around(rng, crowd, rng.uniform(0.992, 0.999)), label) for _ in range(60)] + [(crowd, label)] * 30
        wide = unit()
        rows += [(around(rng, wide, rng.uniform(0.95, 0.99)), label) for _ in range(50)]
        step, other = unit(), unit()
        rows += [(math.cos(a) * step + math.sin(a) * other, label) for a in np.arange(0, 3, 0.3)]
    return [(int(n), v.tolist(), label) for n, (v, label) in enumerate(rows)]


def test_near_dedup_finds_what_brute_force_finds(spark):
    rows = planted()
    want, _ = plain_links(rows)
    df = spark.createDataFrame([(*r, True) for r in rows], "vec_id long, embedding array<double>, label int, kept boolean").repartition(3)
    got = {r.vec_id: r for r in caps.near_duplicates(df).collect()}
    found = sum(r.n_links for r in got.values())
    assert len(got) == len(rows) and found >= 0.97 * sum(want)
    assert all(got[n].n_links <= want[n] for n in got)  # nothing below the bound is linked
    crowd = 120  # the first label's crowd, whose links are found whole
    assert all(got[n].n_links >= 89 for n in range(crowd, crowd + 90)) and len({got[n].component_id for n in range(crowd, crowd + 90)}) == 1
    assert all(r.kept == (r.vec_id == r.component_id) and r.component_id <= r.vec_id for r in got.values())


def test_filters_find_near_pairs():
    rng = np.random.default_rng(5)
    for dims, codes in ((64, 97), (64, 400), (8, 60), (100, 200)):
        filters = caps.Filters(dims, codes)
        x = rng.standard_normal((300, dims))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = np.array([around(rng, v, 0.93) for v in x])
        one, two = (set(zip(*map(np.ndarray.tolist, filters.decoded(v)), strict=True)) for v in (x, y))
        assert len({row for row, _ in one & two}) >= 0.95 * len(x)
        assert min(np.bincount([row for row, _ in one])) >= caps.TABLES * caps.FEWEST
        # what is listed is all that exceeds the threshold
        cosines = (((x[:5] @ filters.rotations[0])[:, : filters.cuts[0]] @ filters.blocks[0][0].T)[:, :, None, None] + ((x[:5] @ filters.rotations[0])[:, filters.cuts[0] : sum(filters.cuts[:2])] @ filters.blocks[0][1].T)[:, None, :, None]) if codes <= 100 else None
        if cosines is not None:
            every = cosines + ((x[:5] @ filters.rotations[0])[:, sum(filters.cuts[:2]) :] @ filters.blocks[0][2].T)[:, None, None, :]
            passed = {(r, a * codes**2 + b * codes + c) for r, a, b, c in zip(*map(np.ndarray.tolist, np.nonzero(every >= filters.threshold)), strict=True)}
            assert passed <= {(r, f) for r, f in one if r < 5}


def test_near_dedup_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, [2.0, 4.0, 6.0], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0] * 3, 1), (8, [1.0, None, 3.0], 1), (9, [float("nan"), 2.0, 3.0], 1), (10, [1.0, 2.0], 1)]
    rows += [(2, v, 1), (None, v, 1), (None, [3.0, -1.0, 0.0], 1), (11, [1e200, 2e200, 3e200], 1), (12, [1e-200, 2e-200, 3e-200], 1), (13, [-1.0, -2.0, -3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((str(tuple(r)) for r in caps.near_duplicates(df).collect()))
    linked = [(i, 5, 1, i == 1) for i in (1, 2, 2, None, 11, 12)]
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 13, None)]
    assert got == sorted(map(str, linked + alone))
    assert caps.near_duplicates(df.limit(0)).count() == 0
    assert caps.near_duplicates(df.where("vec_id = 4")).collect()[0].n_links == 0
