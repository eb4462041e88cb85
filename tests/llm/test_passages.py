"""Repeated passages to their last byte."""

from __future__ import annotations

import random
import time
from pathlib import Path

from terroir.llm import chunk_dedup as C


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijé") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_passages_of_51_words_are_whole(spark):
    rng = random.Random(11)
    docs, where = {}, {}
    for i in range(300):
        passage = prose(rng, 51)
        for doc in (i, 1000 + i):
            before = prose(rng, 20)
            docs[doc] = f"{before} {passage} {prose(rng, 20)}"
            where[doc] = len(before.encode()) + 1, len(f"{before} {passage}".encode())
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    rows = C.passages(df).collect()
    whole = {r.doc_id for r in rows if r.start_byte <= where[r.doc_id][0] and r.end_byte >= where[r.doc_id][1]}
    assert len(whole) >= 0.99 * len(docs)
    for r in rows:
        other = docs[r.doc_id + 1000 if r.doc_id < 1000 else r.doc_id - 1000].encode()
        found = docs[r.doc_id].encode()[r.start_byte : r.end_byte]
        assert found in other
        assert r.n_words == len(found.split()) >= C.LEAST_WORDS
        assert r.keep_id == r.doc_id % 1000
    cut = {r.doc_id: r.text for r in C.cut(df).collect()}
    for doc in whole:
        a, b = where[doc]
        text = docs[doc].encode()
        assert cut[doc] == docs[doc] if doc < 1000 else len(cut[doc].encode()) <= len(text) - (b - a)


def test_passages_of_50_words_are_left(spark):
    rng = random.Random(12)
    docs = []
    for i in range(40):
        passage = prose(rng, 48)
        docs += [(doc, f"{prose(rng, 20)} {passage} {prose(rng, 20)}") for doc in (i, 1000 + i)]
    assert C.passages(spark.createDataFrame(docs, "doc_id long, text string")).count() == 0


def test_chunks_keep_their_places_beside_the_text(spark):
    rng = random.Random(13)
    texts = [prose(rng, n) for n in (1, 40, 300)] + ["x" * 70_000, "\n" * 9, "é"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    table = C.settle(C.chunk_texts(df))
    met = C._met(table, C.settle(C._repeated(table))).collect()
    want = set()
    for doc, text in docs:
        data = text.encode()
        kept = [(a, b) for a, b in C.chunks(data)[0].T.tolist() if b - a >= C.LEAST_BYTES]
        words = lambda n: sum(not x.isspace() and (i == 0 or data[i - 1 : i].isspace()) for i, x in ((i, data[i : i + 1]) for i in range(n)))  # noqa: B023, E731
        for i, (a, b) in enumerate(kept):
            low, high = (max(kept[i - 1][0] - C.REACH, 0) if i else 0), (kept[i + 1][1] if i + 1 < len(kept) else len(data))
            want.add((doc, i, a, b, words(a), words(b), words(low), words(high)))
    got = [(r.doc_id, r.idx, r.start, r.end, r.before, r.upto, r.low, r.high) for r in met]
    assert len(got) == len(set(got))
    assert set(got) == want
    assert all(r.place & 0xFFFFFFFF == r.start and r.keep_id == r.doc_id % 100 for r in met)


def test_disk_of_a_step_is_given_back(spark, monkeypatch):
    """The shuffles of one table are gone before the next is made, and the chunks take less than their texts."""
    rng = random.Random(14)
    lines = [prose(rng, 60) for _ in range(1500)]
    docs = [(i, " ".join(rng.choice(lines) if rng.random() < 0.2 else prose(rng, 60) for _ in range(5))) for i in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    local = [Path(d.getPath()) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {f for d in local for f in d.rglob("shuffle_*.data")}
    before, left, tables = shuffles(), [], []
    settle = C.settle

    def watched(*args, **more):
        out = settle(*args, **more)
        until = time.time() + 10
        while (new := shuffles() - before) and time.time() < until:
            time.sleep(0.1)
        left.append(len(new))
        tables.append(sum(Path(f.removeprefix("file://")).stat().st_size for f in out.inputFiles()))
        return out

    monkeypatch.setattr(C, "settle", watched)
    assert C.passages(df).count() > 0
    assert left == [0] * len(left)
    assert tables[0] < 0.9 * sum(len(t.encode()) for _, t in docs)
