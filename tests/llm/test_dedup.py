from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from terroir.llm import exact_dedup as X
from terroir.llm import line_dedup as L

TEXTS = ["a  b", "a b", "a\tb", " a b", "a b ", "", None, "  ", "\n", "é", "e", "x" * 50_000, "A b"]


def test_exact_dedup(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], "x", 1) for i in range(60)] + [(7, "twice", "", 0), (7, "twice", "", 0), (None, "twice", "", 0)]
    got = Counter(tuple(r) for r in X.dedup(spark.createDataFrame(rows, "doc_id long, text string, fp string, keep_id int").repartition(5)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append(i)
    want = Counter()
    for i, t, *_ in rows:
        ids = groups[norm(t)]
        keep = min(x for x in ids if x is not None)
        want[i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()] += 1
    assert got == want
    assert X.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(2)
    parts = [rng.integers(0, 1 << 64, 500, dtype=np.uint64) for _ in range(3)]
    parts[1][:100] = parts[0][:100]
    rows = [r for p in parts for r in X._runs(p, np.ones(len(p), np.int64), 10)]
    held = defaultdict(list)
    for q, r, c in rows:
        held[q].append((q, r, c))
    total = {}
    for block in held.values():
        fps, counts = X._unpacked([b[0] for b in block], [b[1] for b in block], [b[2] for b in block], 10)
        for q, r, c in X._runs(fps, counts, 10):
            f, n = X._unpacked([q], [r], [c], 10)
            assert (np.diff(f.astype(object)) > 0).all()
            total.update(zip((f & ~np.uint64(1023)).tolist(), n.tolist(), strict=True))
    # a remainder keeps all bits of its fingerprint below the quotient
    assert total == Counter((np.concatenate(parts) & ~np.uint64(1023)).tolist()) or sum(total.values()) == 1500


def lines_brute(docs, least=40, most=5):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n") if i is not None else ():
            if len(key(x)) >= least:
                holders[key(x)].add(i)
    out = Counter()
    for i, t in docs:
        lines = (t or "").split("\n")
        gone = [i is not None and len(h := holders.get(key(x), ())) >= most and i != max(h) for x in lines]
        out[i, len(lines), sum(gone), hashlib.sha256("\n".join(x for x, g in zip(lines, gone, strict=True) if not g).encode()).hexdigest()] += 1
    return out


def sample_docs():
    rng = random.Random(4)
    long = [("Line %d of a repeated footer that is quite long é " % i) + "x" * 5 for i in range(6)]
    docs = []
    for i in range(60):
        own = [f"own line {i} {j} " + "words and words " * 3 for j in range(rng.randint(0, 3))]
        docs.append((i, "\n".join(rng.sample([*own, *(x if rng.random() < 0.5 else f"  {x.upper() if x.isascii() else x}\t" for x in rng.sample(long, rng.randint(0, 4))), "short"], k=min(3, len(own) + 1)))))
    return [*docs, (60, None), (61, ""), (62, "\n\n"), (63, long[0] + "\n" + long[0]), (None, long[0]), (5, None), (5, long[0] + "\nx"), (6, "\n" + long[1]), (60, long[0] * 3000)]


def told(df):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4)


def test_lines(spark):
    docs = sample_docs()
    df = frame(spark, docs)
    assert told(L.LineIndex.build(df).report(df)) == lines_brute(docs)
    kept = L.LineIndex.build(df).apply(df)
    assert Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in kept.collect()) == Counter((i, h) for i, _, _, h in lines_brute(docs).elements())
    extra = spark.createDataFrame([(1, "t", b"k", 2, 3, 4, "r")], "doc_id long, text string, key binary, n_lines int, n_dropped int, keys int, row string")
    assert L.LineIndex.build(extra).apply(extra).schema == extra.schema
    assert L.LineIndex.build(extra).apply(extra).collect() == extra.collect()
    empty = frame(spark, [])
    assert L.LineIndex.build(empty).report(empty).count() == 0


def test_lines_of_very_many_documents(spark, monkeypatch):
    monkeypatch.setattr(L, "HOT", 8)
    docs = sample_docs()
    df = frame(spark, docs)
    assert told(L.LineIndex.build(df).report(df)) == lines_brute(docs)


def test_insert_and_delete_equal_a_rebuild(spark):
    docs = sample_docs()
    first, second = frame(spark, docs[:30]), frame(spark, docs[30:])
    whole = frame(spark, docs)
    index = L.LineIndex.build(first).insert(second)
    assert told(index.report(whole)) == lines_brute(docs)
    gone = [i for i, _ in docs if i is not None and i % 3 == 0]
    left = [d for d in docs if d[0] is None or d[0] % 3]
    after = index.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
    rest = frame(spark, left)
    assert told(after.report(rest)) == lines_brute(left)
    keys = [r.key for r in after.refs.collect()]
    loaded = {r.shard: L.Cuckoo.load(r.blob) for r in after.filter_rows.collect()}
    for k in keys:
        digest = L._rows([k])
        assert loaded[int(L.shard_of(digest, after.shards)[0])].may_hold(digest).all()


def test_cuckoo_filter():
    digests = [L.digest(str(i).encode()) for i in range(3000)]
    made = L.Cuckoo.of(digests)
    assert made.may_hold(L._rows(digests)).all()
    assert L.Cuckoo.load(made.dump()).may_hold(L._rows(digests)).all()
    others = L._rows([L.digest(f"o{i}".encode()) for i in range(20_000)])
    assert made.may_hold(others).mean() < 0.01
    for d in digests[:1500]:
        made.discard(d)
    assert made.may_hold(L._rows(digests[1500:])).all()
    assert made.may_hold(L._rows(digests[:1500])).mean() < 0.05
    assert (made.slots > 0).sum() == 1500


@pytest.mark.parametrize("text", [None, b"", b" ", b"a\n\n b\t", b"\x0b\x0c"])
def test_normalised(text):
    assert X.normalised(text) == re.sub(rb"[\x20\x09-\x0d]+", b" ", text or b"")


def test_arrow_types():
    assert X._blocks(iter([])).schema.field("remainders").type == pa.binary()


def test_line_index_through_many_changes(spark, monkeypatch):
    """Fifty times the documents, one batch after the other: equal to a rebuild, in more shards; a change rewrites no posting."""
    monkeypatch.setattr(L, "SHARD_POSTINGS", 4)
    monkeypatch.setattr(L, "PARTS", 4)
    rng = random.Random(77)
    notices = [f"Notice number {n} that many of these pages have at their end." for n in range(40)]
    docs = [(i, "\n".join([rng.choice(notices), f"own line {i} " + "and more words " * 3, rng.choice(notices)])) for i in range(300)]
    df = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = L.LineIndex.build(df(docs[:6]))
    one = index.insert(df(docs[6:7]))
    assert set(index.posted.inputFiles()) < set(one.posted.inputFiles())
    index, at = one, 7
    for step in (13, 40, 90, 150):
        index, at = index.insert(df(docs[at : at + step])), at + step
    index = index.delete(df(docs[5:260:9])).insert(df([(0, docs[1][1]), (None, docs[2][1])]))
    left = [d for d in docs if d not in docs[5:260:9]]
    assert index.shards > 16
    assert told(index.report(df(left))) == lines_brute_of(left, [(0, docs[1][1])])
    assert [c.count() for c in (L._by_all(index.posted, index.filter_rows, index.shards), L._by_shard(index.posted, index.filter_rows, index.shards))] == [L._by_all(index.posted, index.filter_rows, index.shards).count()] * 2


def lines_brute_of(docs, more):
    """What is left of ``docs`` when ``more`` are known as well."""
    holders = {}
    for i, t in [*docs, *more]:
        for x in t.split("\n"):
            if len(x.strip()) >= 40:
                holders.setdefault(L.key(x.encode()), set()).add(i)
    out = Counter()
    for i, t in docs:
        lines = t.split("\n")
        gone = [len(h := holders.get(L.key(x.encode()), ())) >= 5 and i != max(h) for x in lines]
        out[i, len(lines), sum(gone), hashlib.sha256("\n".join(x for x, g in zip(lines, gone, strict=True) if not g).encode()).hexdigest()] += 1
    return out
