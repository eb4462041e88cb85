from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terroir.llm import components as K
from terroir.llm import ngram_join as N


def shingles(text, k):
    ws = (text or "").encode().lower().split()
    return {tuple(ws[i : i + k]) for i in range(max(len(ws) - k + 1, 1))} if ws else set()


def brute(docs, m):
    sets = [shingles(t, m.words) for _, t in docs]
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and m.den * len(a & sets[j]) >= m.num * len(a | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(docs))


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    docs = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.55 and docs:
            ws = (rng.choice(docs)[1] or "x").split()
            for _ in range(rng.randint(0, 3)):
                ws[rng.randrange(len(ws))] = rng.choice(vocabulary)
        else:
            ws = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
            if kind > 0.8:
                ws = passage + ws[: rng.randint(1, 20)]
        docs.append((i, " ".join(ws)))
    return [*docs, (n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "One"), (n + 4, "one"), (n + 5, "one two")]


@pytest.mark.parametrize(("seed", "measure"), [(1, N.Measure(3, 90)), (2, N.Measure(5, 80))])
def test_components_equal_brute_force(spark, monkeypatch, seed, measure):
    monkeypatch.setattr(N, "MET", 2)
    docs = corpus(seed)
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, sig string").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in N.grouped(df, measure)[0].collect())
    assert got == brute(docs, measure)


def test_hot_group_and_empty_table(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    docs = []
    for i in range(120):
        ws = list(base)
        ws[rng.randrange(200)] = f"u{i}"
        docs.append((i, " ".join(ws)))
    m = N.Measure(3, 90)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in N.grouped(spark.createDataFrame(docs, "doc_id long, text string"), m)[0].collect()) == brute(docs, m)
    assert N.grouped(spark.createDataFrame([], "doc_id long, text string"), m)[0].count() == 0


def test_one_of_each(spark):
    docs = [(3, "a b c d e f"), (1, "A b c d e f"), (2, "q r s t u v"), (None, "q r s"), (4, None), (1, "A b c d e f")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, row string")
    kept = N.one_of_each(df, N.Measure())
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "q r s"), (1, "A b c d e f"), (1, "A b c d e f"), (2, "q r s t u v"), (4, "")]


def test_sketches_never_rule_out_too_much():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 300, 5000):
        a = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        for share in (0.0, 0.5, 0.9, 1.0):
            b = np.unique(np.concatenate((a[: int(len(a) * share)], rng.integers(0, 1 << 64, max(1, int(n * (1 - share) * 1.5)), dtype=np.uint64))))
            differ = len(np.setxor1d(a, b))
            assert N.apart(N.sketch(a), N.sketch(b)) <= differ


@pytest.mark.parametrize("k", [2, 3, 4])
def test_prefixes_of_linked_sets_meet(k):
    rng = np.random.default_rng(5)
    m = N.Measure(3, 80)
    universe = np.unique(rng.integers(0, 1 << 64, 3000, dtype=np.uint64))
    levels = dict(zip(universe.tolist(), rng.integers(0, 8, len(universe)).tolist(), strict=True))

    def keys(found):
        """Level 0 is for tokens that no other set holds."""
        level = np.array([levels[x] for x in found.tolist()], np.int64)
        order = np.lexsort((found, level))
        found, level = found[order], level[order]
        alone = int((level == 0).sum())
        missing = m.errors(len(found)) + 1 - alone
        return N.prefix_keys(found[alone:], level[alone:], missing, len(found), m, k) if missing > 0 else np.zeros(0, np.uint64)

    met = 0
    for _ in range(400):
        a = rng.choice(universe, rng.integers(1, 140), replace=False)
        b = np.concatenate((a[rng.integers(0, max(1, len(a) // 9)) :], rng.choice(universe, rng.integers(0, max(1, len(a) // 10)))))
        for x in np.setxor1d(a, b):
            levels[x] = 0
        for x in np.intersect1d(a, b):
            levels[x] = max(1, levels[x])
        a, b = np.unique(a), np.unique(b)
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            met += 1
            assert len(np.intersect1d(keys(a), keys(b)))
    assert met > 100


@pytest.mark.parametrize("measure", [N.Measure(3, 90), N.Measure(3, 80)])
def test_differences_of_linked_sets_meet(measure):
    """Edited copies of a base: two that are linked, but not both with the pivot, share a key of their differences."""
    rng, met = np.random.default_rng(3), 0
    for _ in range(60):
        base = np.unique(rng.integers(0, 1 << 64, int(rng.integers(5, 400)), dtype=np.uint64))
        pool = np.unique(rng.integers(0, 1 << 64, 60, dtype=np.uint64))
        copies = []
        for _ in range(12):
            kept = base[rng.random(len(base)) > rng.choice([0.0, 0.03, 0.06, 0.1])]
            more = rng.choice(pool, rng.integers(0, max(2, len(base) // 12)))
            copies.append(np.unique(np.concatenate((kept, more, rng.integers(0, 1 << 64, rng.integers(0, max(2, len(base) // 20)), dtype=np.uint64)))))
        tokens, counts = np.unique(np.concatenate(copies), return_counts=True)
        level = dict(zip(tokens.tolist(), (np.frexp(counts)[1] - 1).tolist(), strict=True))
        alone = set(tokens[counts == 1].tolist())

        def told(x, alone=alone, level=level):
            again = np.array([t not in alone for t in x.tolist()], bool)
            return len(x), x[again], np.array([level[t] for t in x[again].tolist()], np.uint8)

        sets = [told(x) for x in copies]
        found = [N.difference_keys(x, sets[0], 77, measure) for x in sets]
        for i in range(1, 12):
            for j in range(1, i):
                common = len(np.intersect1d(copies[i], copies[j]))
                if measure.holds(common, len(copies[i]), len(copies[j])) and not (found[i][0] and found[j][0]):
                    met += 1
                    assert len(np.intersect1d(found[i][1], found[j][1]))
    assert met > 50


def test_a_small_pivot_gives_a_large_set_few_keys():
    rng, m = np.random.default_rng(4), N.Measure(5, 80)
    x, p = (np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64)) for n in (6000, 40))
    p[:4] = x[:4]
    p.sort()
    linked, keys = N.difference_keys((len(x), x, np.full(len(x), 3, np.uint8)), (len(p), p, np.full(len(p), 3, np.uint8)), 9, m)
    assert not linked and 0 < len(keys) < 10 * len(x)


def test_few_sets_of_a_pivot_share_one_key(spark, monkeypatch):
    """One row for each set, however they overlap; with more sets their differences are indexed. Links with the pivot are the same."""
    rng, m = np.random.default_rng(6), N.Measure(5, 80)
    pool = np.unique(rng.integers(0, 1 << 64, 400, dtype=np.uint64))
    sets = [pool[:300], *(np.sort(rng.choice(pool, 300, replace=False)) for _ in range(20)), pool[:290]]
    columns = "sid long, n long, weight double, tokens binary, levels binary"
    held = spark.createDataFrame([(i, len(x), 1.0, x.tobytes(), bytes([3] * len(x))) for i, x in enumerate(sets)], columns)
    pairs = spark.createDataFrame([(i, 0) for i in range(1, len(sets))], "a long, b long")
    few = N.differences(pairs, held, m).collect()
    monkeypatch.setattr(N, "PAIRS_PER_ROW", 0.5)
    more = N.differences(pairs, held, m).collect()
    assert len(few) == len(pairs.collect()) and len({k for r in few for k in r["keys"]}) == 1 and all(len(r["keys"]) == 1 for r in few)
    assert sum(len(r["keys"]) for r in more) > 10 * len(more)
    assert {r.a for r in few if r.linked} == {r.a for r in more if r.linked} == {len(sets) - 1}


def test_rows_of_a_crowded_key_are_placed_twice(spark):
    rows = spark.range(6000).select("id", F.lit(6000).alias("c"), F.lit(7).alias("size"))
    assert {(r["size"], r.block): r["count"] for r in N.placed_twice(rows).groupBy("size", "block").count().collect()} == {(6, 0): 6000, (7, 0): 6000}


def test_near_pairs_of_unlike_sizes_and_blocks(spark, monkeypatch):
    """Every pair that parities and sizes allow is made once, at the edges of classes of sizes too, in one block and in several."""
    rng, m = np.random.default_rng(2), N.Measure(3, 80)
    base = np.unique(rng.integers(0, 1 << 64, 125, dtype=np.uint64))
    sets = [base[:n] for n in range(60, 126)]
    held = spark.createDataFrame([(i, len(x), x.tobytes()) for i, x in enumerate(sets)], "sid long, n long, tokens binary")
    rows = held.select("sid", F.lit(1).cast("long").alias("key"), "n", F.col("sid").alias("comp"), F.lit(len(sets)).cast("long").alias("c"))
    want = {(i, j) for j in range(len(sets)) for i in range(j) if m.holds(len(sets[i]), len(sets[i]), len(sets[j]))}
    for block in (8192, 10):
        monkeypatch.setattr(N, "BLOCK", block)
        got = [(r.a, r.b) for r in N.near_pairs(rows, held, m).collect()]
        assert len(got) == len(set(got)) and want <= set(got)


def test_crowded_keys_and_hot_tokens(spark, monkeypatch):
    """Sets that share most tokens but aren't linked, with pivots until nothing is left; tokens of every document."""
    monkeypatch.setattr(N, "PAIRS_PER_ROW", 0.5)
    rng = random.Random(8)
    pool = [f"p{i} q{i} r{i}" for i in range(40)]
    docs = []
    for i in range(24):
        parts = rng.sample(pool, 30) if i % 7 else docs[-1][1].split(" | ")[1:] + ["p0 q0 r0"] if docs else pool[:30]
        docs.append((i, " | ".join(parts)))
    m = N.Measure(3, 80)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in N.grouped(df, m)[0].collect()) == brute(docs, m)


def test_components(spark):
    links = [(1, 2), (3, 2), (9, 8), (8, 7), (7, 6), (6, 5), (20, 20), *((100 + i, 100) for i in range(1, 60)), (159, 200)]
    got = {r.node: r.component for r in K.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, **dict.fromkeys(range(5, 10), 5), **dict.fromkeys([*range(100, 160), 200], 100)}


def test_components_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(K, "STEP_EDGES", 4)  # the links stay in the tasks that they are in
    links = [*((i, i + 1) for i in range(0, 400, 2)), *((i + 1, i + 2) for i in range(0, 200, 2)), (700, 600), (500, 600), (500, 500)]
    df = spark.createDataFrame(links, "a long, b long").repartition(16)
    got = {r.node: r.component for r in K.components(df).collect()}
    assert got == {**dict.fromkeys(range(201), 0), **{i: i // 2 * 2 if i > 201 else 0 for i in range(201, 400)}, 201: 0, **dict.fromkeys((500, 600, 700), 500)}
    assert {r.node for r in K.stars(df).collect()} == {n for n, c in got.items() if n != c}


def test_components_without_links(spark):
    empty = spark.createDataFrame([], "a long, b long")
    assert K.components(empty).count() == K.stars(empty).count() == 0
