"""Language ID, personal data, chunks, URLs and quotes."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from terroir.llm import chunk_dedup as C
from terroir.llm import language_id as L
from terroir.llm import pii as P
from terroir.llm import quote_links as Q
from terroir.llm import url_filters as U

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.op10_language_id(spark, SF).join(docs, "doc_id").where("held_out and length(text) >= 40")
    right, total = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert total > 200
    assert right / total > 0.98
    assert {r.held_out for r in L.op10_language_id(spark, SF).select("held_out").distinct().collect()} == {True, False}


def test_language_odd_texts(spark):
    net = L.train(L.windows_of([b"abc abc abc", b"xyz xyz xyz"] * 30)[0], np.array([0, 1] * 30), ("a", "x"))
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "abc abc"), (5, "xyz " * 9000), (None, "abc")]
    df = spark.createDataFrame([(*r, "a") for r in rows], "doc_id long, text string, score string")
    got = {r.row.doc_id: (r.lang_pred, 0 <= r.score <= 1) for r in L.predict(df, net, ["doc_id", "score"]).collect()}
    assert got == {1: ("und", True), 2: ("und", True), 3: ("und", True), 4: ("a", True), 5: ("x", True), None: ("a", True)}
    assert L.learn(df.select("doc_id", "text", F.lit(None).cast("string").alias("lang"))) is None
    assert {r.lang_pred for r in L.predict(df, None, ["doc_id"]).collect()} == {"und"}
    assert L.predict(df.limit(0), net, ["doc_id"]).count() == 0


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(digits[::-1])) % 10 == 0 if digits else False
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 16 <= len(digits) <= 19 and luhn, "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(6)
    texts = ["a.b@c.d x", "a@b@c.d", "x@y.z_q@w.e", "1.2.3.4.5.6.7.8", "300.1.1.1", "4111 1111 1111 1111", "+1 (555) 555-0100 ext", "++1 22", "é@a.b-ü", "@a.b", "a@.b", "0004.1.2.255", "1" * 5000]
    texts += ["".join(rng.choice("ab1209@.+ -()_é") for _ in range(rng.randint(5, 70))) for _ in range(3000)]
    for t in texts:
        assert ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in P.base_spans(t)) == brute_spans(t), t


def test_pii_discovers_by_context(spark):
    rng = random.Random(2)
    filler = lambda: " ".join(rng.choice(["of", "the", "and", "was", "here"]) for _ in range(8))
    docs = [(i, f"{filler()} reach me: user{i}@mail.example.com {filler()}") for i in range(30)] + [(100, f"{filler()} reach me: (id-993847) {filler()}"), (101, None), (102, "")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in P.find(df, P.patterns(df)).collect()}
    assert len(got) == len(docs)
    assert got[0].n_email == 1
    assert got[0].base_sha256 == hashlib.sha256(got[0].spans.encode()).hexdigest()
    start = docs[30][1].index("id-993847")
    assert got[100].spans == f"id:{start}:{start + 9}"
    assert got[101].spans == got[102].spans == ""
    assert P.find(df.limit(0), P.patterns(df.limit(0))).count() == 0
    assert P.redact("mail a@b.cd now") == "mail <email> now"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_chunks_find_planted_passages(spark):
    rng = random.Random(7)
    docs = [[i, prose(rng, 150)] for i in range(40)]
    planted = set()
    for _ in range(10):
        passage = prose(rng, 55)
        for i in rng.sample(range(40), 3):
            ws = docs[i][1].split()
            at = rng.randrange(len(ws))
            docs[i][1] = " ".join([*ws[:at], passage, *ws[at:]])
            planted.add(i)
    docs += [[50, None], [51, ""], [None, prose(rng, 80)]]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, idx int").repartition(3)
    found = {r.doc_id for r in C.passages(df).collect()}
    assert found <= planted
    assert len(found) >= 0.9 * len(planted)
    cut = C.cut(df)
    assert cut.columns == df.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert all(texts[i] == t for i, t in docs if i not in planted)
    assert C.passages(df.limit(0)).count() == 0


def test_chunks_resist_insertions():
    rng = random.Random(1)
    text = prose(rng, 2000).encode()
    moved = text[:5000] + b"inserted" + text[5000:]
    pieces = lambda t: [t[a:b] for a, b in C.chunks(t)[0].T.tolist()]
    assert b"".join(pieces(text)) == text
    assert len(set(pieces(text)) - set(pieces(moved))) <= 3


def test_rolling_hash_is_the_gear_hash():
    data, h, want = np.frombuffer(b"some bytes to hash", np.uint8), 0, []
    for b in data:
        h = ((h << 1) + int(C.GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    low = np.uint32(0xFFFF)
    assert ((C.rolling(data) & low) == (np.array(want, np.uint32) & low)).all()


def test_urls(spark):
    urls = {1: "https://Blog.A.Example.ORG/es/x?y#z", 2: "http://example.org/en/12", 3: "http://notexample.org/en/12", 4: "http://m.site.com/fr/1", 5: "http://site.com/de/", 6: "http://com", 7: None, 8: "no scheme", 9: "ftp://x.net?q=://y/z", 10: "http://org/#f"}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(k, v, 1) for k, v in urls.items()], "page_id long, url string, host int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df, labels).collect()}
    assert got == {
        1: ("blog.a.example.org", "/es/x", "example.org/es/", "block"), 2: ("example.org", "/en/12", "example.org/en/1", "block"), 3: ("notexample.org", "/en/12", "org/", "allow"), 4: ("m.site.com", "/fr/1", "com/fr/", "allow"),
        5: ("site.com", "/de/", "com/de/", "block"), 6: ("com", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("x.net", "", None, "allow"), 10: ("org", "/", "org/", "allow"),
    }
    assert U.judge(df.limit(0), labels).count() == 0


def test_urls_learn_from_labels(spark):
    rng = random.Random(3)
    pages = [(i, f"http://{'bets' if i % 4 == 0 else rng.choice(['news', 'blog'])}.site.net/{rng.choice(['en', 'fr'])}/{i}") for i in range(400)] + [(999, "http://bets.other.net/xx"), (998, "http://news.other.net/xx"), (998, "http://news.other.net/xx")]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(300)] + [(None, 0, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = [(r.page_id, r.verdict) for r in U.judge(spark.createDataFrame(pages, "page_id long, url string"), labels).collect()]
    assert len(got) == len(pages)
    assert {i for i, v in got if v == "block"} == {i for i in range(0, 400, 4)} | {999}


def test_quotes(spark):
    rows = [
        (1, 0, "user", "How do I sharpen a kitchen knife?"), (1, 1, "assistant", "Use a whetstone at twenty degrees.\nThen strop it well."),
        (1, 2, "user", "> Use a whetstone  at TWENTY degrees.\nWhich grit?"), (1, 3, "assistant", "> > Use a whetstone at twenty degrees.\n> Which grit is fine for it\nA thousand."),
        (1, 4, "user", ">How do I sharpen a kitchen knife?\nasked again"), (2, 0, "user", "> Use a whetstone at twenty degrees.\nnot mine"), (2, 1, "user", None), (2, 2, "user", ""), (None, 0, "user", "x"), (3, None, "user", "y"), (3, 1, "user", "> only a quote of nothing"),
    ]
    df = spark.createDataFrame([(*r, "p") for r in rows], "conv_id long, turn long, role string, text string, body string")
    got = {(r.conv_id, r.turn): r for r in Q.link(df).collect()}
    assert len(got) == len(rows)
    assert [got[1, t].parent_turn for t in range(5)] == [None, None, 1, 1, 0]
    assert [got[1, t].quote_depth for t in range(5)] == [0, 0, 1, 2, 1]
    assert got[1, 2].body == "Which grit?"
    assert [(got[1, t].thread_turn, got[1, t].depth) for t in range(5)] == [(0, 0), (1, 0), (1, 1), (1, 1), (0, 1)]
    assert got[2, 0].parent_turn is None
    assert got[2, 1].body == got[2, 2].body == got[3, 1].body == ""
    assert Q.link(df.limit(0)).count() == 0


def test_long_chains_and_repeated_turns(spark, monkeypatch):
    """Each message quotes the one before it; one turn is there twice, and all share a line that is often repeated."""
    monkeypatch.setattr(Q, "BLOCK", 16)
    n = 300
    rows = [(1, i, f"> number {i - 1} says something of its own here\n> same old signature line\nnumber {i} says something of its own here\nsame old signature line") for i in range(n)]
    rows += [(1, 7, rows[7][2]), (2, 0, "hello over there"), (2, 5, "> hello over there\nyes"), (2, 40, "> hello over there\nno")]
    got = Q.link(spark.createDataFrame([(*r, "u", 1) for r in rows], "conv_id long, turn int, text string, role string, depth int")).collect()
    assert len(got) == len(rows)
    one = {r.turn: r for r in got if r.conv_id == 1}
    assert [(one[i].parent_turn, one[i].thread_turn, one[i].depth) for i in range(1, n)] == [(i - 1, 0, i) for i in range(1, n)]
    assert {r.turn: r.parent_turn for r in got if r.conv_id == 2} == {0: None, 5: 0, 40: 0}


def test_latest_original_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(Q, "BLOCK", 8)
    rng = random.Random(12)
    quotes = {(rng.randrange(3), rng.randrange(60), rng.randrange(4)) for _ in range(150)}
    originals = {(rng.randrange(3), rng.randrange(60), rng.randrange(4)) for _ in range(100)}
    asked = spark.createDataFrame([(c, t, h, h) for c, t, h in quotes], "conv_id long, turn long, h1 long, h2 int")
    given = spark.createDataFrame([(c, t, h, h) for c, t, h in originals], "conv_id long, parent long, h1 long, h2 int")
    want = {(c, t, h, max(u for d, u, g in originals if (d, g) == (c, h) and u < t)) for c, t, h in quotes if any((d, g) == (c, h) and u < t for d, u, g in originals)}
    assert {(r.conv_id, r.turn, r.h1, r.parent) for r in Q._latest(asked, given).collect()} == want


def test_urls_equal_brute_force(spark):
    """Rules by counting all sets of tokens of a small table, against those that are mined."""
    from itertools import combinations

    rng = random.Random(31)
    urls = [f"http://{rng.choice(['a', 'b'])}.{rng.choice(['site', 'home'])}.net/{rng.choice(['x', 'y', 'z'])}/{i}?{rng.choice(['q=1', 'q=1&r=2&s=3', ''])}" for i in range(200)]
    bad = {i for i, u in enumerate(urls) if ("//a.site" in u and "/x/" in u) or "r=2" in u and rng.random() < 0.9}
    pages = spark.createDataFrame([*enumerate(urls), (500, None), (501, "http://c.net/" + "long/" * 5000), (501, urls[0])], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i not in bad), 0) for i in range(150)], "doc_id long, quality int, toxic int")
    own = {r.page_id: frozenset(r.t) for r in pages.select("page_id", U.tokens(F.col("url")).alias("t")).where("page_id < 200").collect()}
    least, sure = 20, U.CONFIDENCE
    rules = set()
    for size in range(1, 8):
        for items in {frozenset(c) for i in range(150) for c in combinations(sorted(own[i]), size)}:
            held = [i for i in range(150) if items <= own[i]]
            if sum(i in bad for i in held) >= least and sum(i in bad for i in held) >= sure * len(held):
                rules.add(items)
    assert rules
    want = {i for i in own if any(r <= own[i] for r in rules)}
    got = {r.page_id: r.verdict for r in U.judge(pages, labels, ()).collect()}
    assert {i for i in own if got[i] == "block"} == want
    assert got[500] == "allow"


def test_chunks_of_rows_that_repeat_an_id(spark):
    rng = random.Random(17)
    passage = prose(rng, 120)
    other = prose(rng, 300)
    rows = [(0, passage), (1, passage), (1, other), (1, None), (2, f"{prose(rng, 40)} {passage} {passage}"), (3, prose(rng, 30_000))]
    df = spark.createDataFrame([(*r, 1, "a", None) for r in rows], "doc_id long, text string, mark int, own string, gone string")
    got = C.cut(df)
    assert got.schema == df.schema
    texts = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert (0, passage) in texts and (1, other) in texts and (1, None) in texts and (3, rows[5][1]) in texts
    assert {r.doc_id for r in C.passages(df).collect()} == {0, 1, 2}
    left = next(t for i, t in texts if i == 1 and t not in (None, other))
    assert len(left) < 60


def test_repeated_chunks_equal_brute_force(spark):
    rng = random.Random(23)
    shared = [prose(rng, 60) for _ in range(4)]
    docs = [(i, " ".join(rng.sample([*shared, prose(rng, 20), prose(rng, 50)], 3))) for i in range(25)]
    holders: dict[bytes, set[int]] = {}
    for i, t in docs:
        for a, b in C.chunks(t.encode())[0].T.tolist():
            if b - a >= C.LEAST_BYTES:
                holders.setdefault(t.encode()[a:b], set()).add(i)
    want = sorted(min(h) for h in holders.values() if len(h) > 1)
    assert sorted(r.keep_id for r in C.repeated(spark.createDataFrame(docs, "doc_id long, text string")).collect()) == want


def test_language_sample_is_bounded_and_empty_table(spark):
    rows = [(7 if k % 2 else k, f"ein kurzer Satz {k}", "de") for k in range(400)] + [(k, "a short one", "en") for k in range(30)] + [(None, "x y z", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = L.sample(docs, per_language=20)
    n = {lang: sum(x == lang for x, _ in got) for lang in ("de", "en", "fr")}
    assert 0 < n["en"] <= 30 and n["de"] <= 40 and not n["fr"]
    none = docs.where("false")
    assert L.learn(none) is None and L.keep_known(none).columns == docs.columns and L.keep_known(none).count() == 0


def test_urls_with_many_optional_keys(spark):
    """Thirty query keys, of which each page lacks one: no more rules than tokens, though nearly all sets of tokens are frequent."""
    keys, rng = [f"k{i}" for i in range(30)], random.Random(3)
    urls = [(n, f"http://shop.net/{n}?" + "&".join(f"{k}={rng.random()}" for k in keys if k != keys[n % 30])) for n in range(1000)]
    pages = spark.createDataFrame([*urls, (5000, "http://shop.net/5000?k3=1"), (5001, "http://other.org/about?zz=1")], "page_id long, url string")
    labels = spark.createDataFrame([(n, 0, 1) for n in range(1000)], "doc_id long, quality int, toxic int")
    rules = U.mined(pages, labels)
    assert {tuple(r.tokens) for r in rules.collect()} == {(t,) for t in ["host=net", *(f"query={k}" for k in keys)]}  # of tokens that all pages hold one stands for the others
    got = {r.page_id: r.verdict for r in U.judge(pages, labels, ()).collect()}
    assert all(got[n] == "block" for n in range(1000)) and got[5000] == "block" and got[5001] == "allow"


def test_urls_keep_the_shortest_rules(spark):
    """Two tokens that are bad only together; longer sets that hold both are spared, whatever else they hold."""
    rows = [(n, f"http://s{n % 3}.net/{'p' if n % 2 else 'q'}/{n}?{'a=1' if n % 5 < 3 else 'b=1'}&c{n % 7}=1") for n in range(600)]
    bad = [n for n, u in rows if "/p/" in u and "a=1" in u]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(n, int(n not in set(bad)), 0) for n, _ in rows], "doc_id long, quality int, toxic int")
    assert {tuple(r.tokens) for r in U.mined(pages, labels, confidence=0.9).collect()} == {("path=p", "query=a")}


def test_identifiers_behind_long_words_and_in_long_texts(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(300))
    one, two = word(), word()
    docs = [(i, f"Start. {one} {two} user{i}@mail.example now") for i in range(20)] + [(50, f"{one} {two} id-993847 end"), (50, f"{one} {two} id-993847 end"), (51, "x " * 100_000 + f"{one}\n{two}  id-993848"), (52, None)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n_id int")
    got = [(r.doc_id, r.spans) for r in P.find(df, P.patterns(df)).collect() if r.doc_id >= 50]
    at = lambda t: f"id:{t.index('id-')}:{t.index('id-') + 9}"
    assert sorted(got) == [(50, at(docs[20][1])), (50, at(docs[20][1])), (51, at(docs[22][1])), (52, "")]
