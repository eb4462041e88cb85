from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from terroir.llm import best_fit_packing as B
from terroir.llm import tokens

PATH = B.vocabulary_path()


def test_ids_are_those_of_the_tokenizer():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    texts = ["", " ", "a", "Hello, world.\nIt's  two   spaces \n\n x", "\tTab nbsp 　wide em", "don't we'll, I'D", "é è ñ ß 日本語 😀 mixed123abc", "<|endoftext|>", "hello <|endoftext|> world", "<|endoftext|><|endoftext|>  x", "<|endoftext |>", "a\x00b", "x" * 3000, "end ", " start", "a\n b", "...,, .5 x.y"]
    texts += ["".join(rng.choice("ab,. \n\t'1é") for _ in range(60)) for _ in range(300)]
    for text in texts:
        assert np.frombuffer(tokens.encode(text, PATH), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
    plain.encode_special_tokens = True
    for text in texts:
        assert np.frombuffer(tokens.encode(text, PATH, added=False), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def check_packing(rows, capacity):
    """Every sequence is gapless from 0 and fits; every document's pieces follow one another."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.piece, r.start, r.length))
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    for members in by_doc.values():
        at = 0
        for k, (piece, start, length) in enumerate(sorted(members)):
            assert (piece, start) == (k, at)
            assert piece == 0 or length == capacity
            at += length
    return len(by_sequence)


def test_pack(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["the", "of", "zebra,", "ing."]) for _ in range(rng.randint(0, 90)))) for i in range(300)] + [(300, None), (301, ""), (302, "many " * 700)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, part int, length string").repartition(3)
    rows = B.pack(df, PATH, capacity=64).collect()
    lengths = {i: len(tokens.encode(t or "", PATH)) // 4 + 1 for i, t in docs}
    assert {r.doc_id for r in rows} == set(lengths)
    assert sum(r.length for r in rows) == sum(lengths.values())
    used = check_packing(rows, 64)
    assert used <= 1.03 * sum(lengths.values()) / 64 + 1
    for r in rows:
        ids = np.frombuffer(tokens.encode(dict(docs)[r.doc_id] or "", PATH) + (2).to_bytes(4, "little"), "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].astype("<u4").tobytes())
    assert B.pack(df.limit(0), PATH).count() == 0


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "d")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.length) for r in B.pack(df, PATH).collect()) == [(0, 2), (1, 4), (1, 4)]


def test_plan_is_as_good_as_first_fit_decreasing():
    rng = random.Random(9)
    for _ in range(60):
        capacity = rng.choice([10, 64, 200])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 150))]
        counts = {n: items.count(n) for n in set(items)}
        fillings = B.plan(counts, capacity)
        placed = defaultdict(int)
        for times, members in fillings:
            assert sum(members) <= capacity
            for n in members:
                placed[n] += times
        assert dict(placed) == counts
        bins = []
        for n in sorted(items, reverse=True):
            for b in bins:
                if sum(b) + n <= capacity:
                    b.append(n)
                    break
            else:
                bins.append([n])
        assert sum(t for t, _ in fillings) <= len(bins) + 1


def test_smallest_member_gives_way_to_a_tighter_pair():
    # greedy: 6 + 3 leaves 1; the pair 2 + 2 fills the gap of 4 that 3 left
    assert B.plan({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [6, 2, 2])
