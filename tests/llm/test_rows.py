"""Rows that repeat ids, miss values or carry clashing columns; replies and their threads in plain Python."""

from __future__ import annotations

import random

import numpy as np

from terroir.llm import exact_dedup as X
from terroir.llm import language_id as L
from terroir.llm import quote_links as Q


def test_exact_dedup_with_clashing_columns(spark):
    rows = [(2, "a  b", 1, "x", None), (1, "a\tb", 2, "y", 5), (3, "a b ", 3, None, 6), (1, "c", 4, "z", 7), (None, "c", 5, "w", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, group_size int, kept string, fp long").repartition(2)
    got = sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept)) for r in X.dedup(df).select("doc_id", "keep_id", "group_size", "kept").collect())
    assert len(got) == len(rows)
    assert str((2, 1, 2, False)) in got and str((1, 1, 2, True)) in got and str((3, 3, 1, True)) in got


def test_languages_of_rows_that_repeat_an_id(spark):
    net = L.train(L.windows_of([b"abc abc abc", b"xyz xyz xyz"] * 30)[0], np.array([0, 1] * 30), ("a", "x"))
    df = spark.createDataFrame([(1, "abc abc", 7), (1, "xyz xyz", 7), (1, None, 8), (1, "abc abc", 7)], "doc_id long, text string, lang_pred int").repartition(2)
    got = sorted((r.row.lang_pred, r.lang_pred) for r in L.predict(df, net, ["doc_id", "lang_pred"]).collect())
    assert got == [(7, "a"), (7, "a"), (7, "x"), (8, "und")]


def test_threads_equal_plain_python(spark):
    rng = random.Random(21)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(3, 8))) for _ in range(n))
    rows, want = [], {}
    for conv in range(6):
        bodies, parents = {}, {}
        for turn in sorted(rng.sample(range(100), 25)):
            bodies[turn] = prose(rng.randint(6, 30))
            parents[turn] = rng.choice([None, *list(bodies)[:-1]])
            quoted = "" if parents[turn] is None else "".join(f"{rng.choice(['>', '> '])}{line}\n" for line in bodies[parents[turn]].replace(" ", "\n", 3).split("\n"))
            rows.append((conv, turn, quoted + bodies[turn], "u"))
            top, depth = turn, 0
            while parents[top] is not None:
                top, depth = parents[top], depth + 1
            want[conv, turn] = (parents[turn], top, depth, bodies[turn])
    # a turn of no number beside a turn that is there twice
    rows += [(9, None, "> nothing that was said before\nhello to all of you here", "u"), (9, 1, "good morning to all of you here", "u"), (9, 1, "good morning to all of you here", "u"), (9, 4, "> good morning to all of you here\nthanks", "u"), (None, 4, None, None)]
    got = Q.link(spark.createDataFrame(rows, "conv_id long, turn long, text string, role string").repartition(3)).collect()
    assert len(got) == len(rows)
    told = {(r.conv_id, r.turn): (r.parent_turn, r.thread_turn, r.depth, r.body) for r in got}
    assert {k: told[k] for k in want} == want
    assert told[9, 4] == (1, 1, 1, "thanks") and told[9, None][0] is None and told[None, 4][0] is None
    assert sum(r.conv_id == 9 and r.turn == 1 for r in got) == 2
