from __future__ import annotations

import hashlib
import random
import re

from terroir.llm import decontamination as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    out = {}
    for i, t in docs:
        ws, hit, named = words(t), set(), set()
        for item, text in items:
            iw = words(text)
            n = min(window, len(iw))
            grams = {tuple(iw[k : k + n]) for k in range(len(iw) - n + 1)} if n else set()
            for k in range(len(ws) - n + 1 if n else 0):
                if tuple(ws[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    named.add(str(item))
        out[i] = (len(ws), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit))
    return out


def cases():
    rng = random.Random(8)
    make = lambda n: " ".join(rng.choice(["a", "B", "c1", "é", "dd"]) for _ in range(n))
    items = [(i, make(rng.randint(0, 9))) for i in range(25)] + [(100, None), (101, "!!"), (7, "extra item with seven")]
    docs = [(i, make(rng.randint(0, 40)) + rng.choice(["", ".", ", ", "\n"]) + make(5)) for i in range(80)] + [(900, None), (901, ""), (902, "--"), (903, "Extra, ITEM\nwith-seven!")]
    return docs, items


def test_report_equals_brute_force(spark):
    docs, items = cases()
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, items string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for window in (4, 6):
        got = {r.doc_id: tuple(r)[1:] for r in D.report(df, bench, window).collect()}
        assert got == brute(docs, items, window)
        many = {r.row.doc_id: [(s.start, s.end) for s in r.spans] for r in D.matches(df, bench, window, most=20).collect()}
        one = {r.row.doc_id: [(s.start, s.end) for s in r.spans] for r in D.matches(df, bench, window).collect()}
        assert {i: sum(b - a for a, b in s) for i, s in many.items()} == {i: sum(b - a for a, b in s) for i, s in one.items()}


def test_remove(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, "Clean text, kept; as it is."), (2, f"Before words here and more of them that are clean. {item.upper()}. After words, also clean ones, of which there are many."), (3, item), (4, None), (5, "")]
    df = spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, source string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.text for r in D.remove(df, bench).collect()}
    assert got == {1: docs[0][1], 2: "Before words here and more of them that are clean. . After words, also clean ones, of which there are many.", 4: None, 5: ""}
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.remove(df, none).count() == 5
    assert not any(r.contaminated for r in D.report(df, none).collect())


def test_parts_hold_each_window_once(spark):
    rng = random.Random(3)
    items = [(i, " ".join(str(rng.randint(0, 10**6)) for _ in range(n))) for i, n in enumerate((1, 4, 5, 29, 30, 31, 34, 35, 100))]
    bench = spark.createDataFrame([*items, items[-1], (50, None), (51, "--")], "item_id long, text string")
    held: dict[int, list[tuple]] = {}
    for r in D.parts(bench, 5, part_words=30).collect():
        got = bytes(r.part).decode().split()
        assert r.n == len(got) <= 34
        held.setdefault(r.item_id, []).extend(tuple(got[k : k + 5]) for k in range(max(1, len(got) - 4)))
    for item, text in items:
        ws = text.split()
        assert sorted(held.pop(item)) == sorted(tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4)))
    assert not held


def test_blocks_hold_all_items(spark):
    items = [(i, " ".join(f"w{i * 7 + k}" for k in range(i % 13))) for i in range(200)]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    found = list(D.blocks(bench, 10, most=100))
    assert len(found) > 5
    assert sorted(x for block in found for x in block) == sorted((i, t.encode()) for i, t in items if t)
    assert list(D.blocks(bench.where("false"), 10)) == [()]


def test_automaton_shared_windows():
    """Windows that several items share name all of them; items repeat words and windows within themselves."""
    rng = random.Random(11)
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))) for i in range(40)]
    made = D.Automaton([(i, D.words(t.encode())) for i, t in items], 6)
    for i in range(200):
        doc = " ".join(rng.choice("abc") for _ in range(30))
        spans, named = made.scan(D.words(doc.encode()))
        _, hit, n_items, digest, _ = brute([(i, doc)], items, 6)[i]
        assert sum(b - a for a, b in spans) == hit and len(named) == n_items
        assert hashlib.sha256(",".join(sorted(map(str, named))).encode()).hexdigest() == digest


def test_removing_sends_texts_to_python_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j and more of it, so that most of these words are not of the item"), (2, "clean"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "A b c d e f g h i j"), (8, "of other words a whole window, and one word more than that")], "item_id long, text string")
    plan = D.remove(docs, items)
    assert plan._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    want = [(1, " and more of it, so that most of these words are not of the item"), (2, "clean"), (3, None)]
    assert sorted(map(tuple, plan.collect())) == want
