from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from terroir.llm import catalog
from terroir.llm import language_id as L

from .test_packing import check_packing

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF)
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), docs.schema)
        assert after.count() <= kept.count()
        kept = after
    ids = {r.doc_id for r in kept.collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == ids
    check_packing(rows, 1024)
    assert len(ids) > 0.8 * docs.count()


def test_every_operator_is_registered():
    names = catalog.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names


# ---- the stages in plain Python; a document is a tuple (doc_id, text, ...)


def plain_network(net, text):
    """Mean probabilities of a text's windows by their bytes: every filter at every place, one after the other."""
    total, data = np.zeros(len(net.languages)), text.encode()
    for at in range(0, max(1, len(data)), L.WINDOW):
        part = data[at : at + L.WINDOW]
        x = net.embedding[np.frombuffer(part.ljust(L.WINDOW, b"\0"), np.uint8)]
        tops = []
        for f, b in zip(net.filters, net.biases, strict=True):
            width = f.shape[0]
            answers = [np.tensordot(x[i : i + width], f, axes=([0, 1], [0, 1])) + b for i in range(L.WINDOW - width + 1)]
            tops.append(np.max(answers, axis=0))
        out = np.maximum(np.concatenate(tops), 0) @ net.dense + net.offset
        e = np.exp(out - out.max())
        total += e / e.sum() * max(1, len(part))
    return total / total.sum()


def plain_language(net, docs):
    return [d for d in docs if d[1] and any(c.isalpha() for c in d[1]) and plain_network(net, d[1]).max() >= 0.3]


def plain_lines(docs):
    holders = {}
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))
    for d in docs:
        for line in (d[1] or "").split("\n"):
            holders.setdefault(key(line), set()).add(d[0])
    kept = lambda line, doc: len(key(line)) < 40 or len(holders[key(line)]) < 5 or max(holders[key(line)]) == doc
    return [(d[0], "\n".join(line for line in d[1].split("\n") if kept(line, d[0])), *d[2:]) for d in docs]


def plain_near(docs):
    def shingles(text):
        words = [w for w in re.split(r"[ \t-\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)) if w]
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [shingles(d[1]) for d in docs]
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group = [group[a] if g == group[b] else g for g in group]
    return [d for n, d in enumerate(docs) if d[0] == min(docs[m][0] for m in range(len(docs)) if group[m] == group[n])]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_benchmark(docs, items):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    windows = set()
    for item in items:
        words = WORD.findall(low(item))
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()
    out = []
    for d in docs:
        found = list(WORD.finditer(low(d[1])))
        hit = [False] * len(found)
        for n in {len(w) for w in windows}:
            for i in range(len(found) - n + 1):
                if tuple(m[0] for m in found[i : i + n]) in windows:
                    hit[i : i + n] = [True] * n
        if sum(hit) > 0.5 * len(found):
            continue
        text, at = "", 0
        for i, m in enumerate(found):
            if hit[i]:
                text += d[1][at : m.start()] if i == 0 or not hit[i - 1] else ""
                at = m.end()
        out.append((d[0], text + d[1][at:], *d[2:]))
    return out


def counted(docs):
    return [(*d[:4], len(d[1]), *d[5:]) for d in docs]


def corpus():
    """Two languages, nulls, rows that repeat, boilerplate, near copies, test items, one long text, and an extra column."""
    rng = random.Random(9)
    english, german = ("the river bends around old stone mill where children throw bread to ducks every morning before school starts again".split(), "der alte müller läuft über die brücke und grüßt täglich jeden gast außer dem schüler der spät zur schule geht".split())
    prose = lambda words, n: " ".join(rng.choice(words) + rng.choice(["", "", "", "."]) for _ in range(n))
    items = [prose(english, 30), prose(german, 14), "stone mill ducks", None, "", "!?"]
    notice = "This page may be copied by anyone who keeps this very notice on it."
    docs = []
    for i in range(90):
        words, lang = (english, "en") if i % 2 else (german, "de")
        text = prose(words, rng.randint(12, 60))
        if i % 6 == 0:
            text = f"{text}\n  {notice.upper() if i % 4 else notice} \nshort"
        if i % 11 == 0:
            text = f"{text[:50]} {items[0]} {text[50:]} {items[1]}"
        docs.append((i, text, lang, "s"))
    for i in range(90, 110):
        words = docs[i - 60][1].split(" ")
        docs.append((i, " ".join(words[:-1] + ["ende" if i % 3 else words[-1]]), docs[i - 60][2], None))
    docs += [(110, None, "en", "s"), (111, "", None, None), (112, "123 !? 4", None, "s"), (113, items[0], "en", "s"), (114, prose(english, 9000), "en", "hot"), (20, docs[20][1], "de", "s"), (21, prose(german, 40), None, None), (115, "Stone MILL\tducks", "en", "s")]
    return [(*d, None if d[1] is None else len(d[1]), d[0] % 3 == 0) for d in docs], items


def test_stages_equal_plain_python(spark, tmp_path):
    docs, items = corpus()
    columns = "doc_id long, text string, lang string, source string, n_chars long, kept boolean"
    spark.createDataFrame(docs, columns).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    net = L.learn(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    plain = {"language": lambda d: plain_language(net, d), "lines": lambda d: counted(plain_lines(d)), "near_duplicates": plain_near, "benchmark": lambda d: counted(plain_benchmark(d, items))}
    want, have = docs, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        want, have = plain[name](want), stage(spark, have, str(tmp_path))
        assert sorted(map(str, map(tuple, have.collect()))) == sorted(map(str, want)), name
        have = spark.createDataFrame(have.collect(), columns)
    assert len(want) < len(docs) - 15
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    for number in {r.sequence_id for r in rows}:
        at = 0
        for offset, length in sorted((r.offset, r.length) for r in rows if r.sequence_id == number):
            assert offset == at
            at += length
        assert at <= 1024
    left = sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows)
    pieces = []
    for d in want:
        ids = np.array([*tokenizer.encode(d[1], add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        ends = [0, len(ids)] if len(ids) <= 1024 else [0, *range(first, len(ids) + 1, 1024)]
        pieces += [(d[0], a, b - a, zlib.crc32(ids[a:b].tobytes())) for a, b in zip(ends, ends[1:], strict=False)]
    assert left == sorted(pieces)
    used = {r.sequence_id for r in rows}
    assert len(used) <= 1 + 1.05 * sum(r.length for r in rows) / 1024


def test_stages_on_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, score double")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, none, SF)
        assert got.columns == none.columns and got.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, none, SF).count() == 0


def test_folded_tables_equal_the_plain_network():
    rng = np.random.default_rng(3)
    shapes = [rng.normal(size=(w, L.EMBEDDING, L.FILTERS)).astype(np.float32) for w in L.WIDTHS]
    net = L.Network(("a", "b", "c"), rng.normal(size=(256, L.EMBEDDING)).astype(np.float32), tuple(shapes), tuple(rng.normal(size=L.FILTERS).astype(np.float32) for _ in L.WIDTHS), rng.normal(size=(3 * L.FILTERS, 3)), rng.normal(size=3))
    texts = ["x", "héllo wörld", "short " * 3, "long text " * 80, "日本語" * 100, "q" * 256, "q" * 257]
    got = L.Predictor(net).texts([t.encode() for t in texts])
    assert np.allclose(got, [plain_network(net, t) for t in texts], atol=1e-4)


def test_workers_forget_the_folded_network(spark):
    docs = spark.createDataFrame([(i, ["the cat and the dog ", "le chat et le chien "][i % 2] * 3, ["en", "fr"][i % 2]) for i in range(60)], "doc_id long, text string, lang string").repartition(4)

    def held(batches):
        from terroir.llm import language_id

        yield from ()
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(language_id._LOADED)]})

    assert L.keep_known(docs).count() > 0
    assert {r.n for r in spark.range(64).repartition(16).mapInArrow(held, "n long").collect()} == {0}
