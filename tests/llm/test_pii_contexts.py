"""Contexts of seeds that don't look like identifiers themselves."""

from __future__ import annotations

import random

import pytest

from terroir.llm import pii as P


def cards(rng):
    while True:
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        if P.luhn(digits):
            yield " ".join(digits[i : i + 4] for i in range(0, 16, 4))


def emails(rng):
    while True:
        yield "".join(rng.choice("abcdefgh") for _ in range(9)) + "@example.org"


def phones(rng):
    while True:
        yield f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"


@pytest.mark.parametrize("seeds", [cards, emails, phones])
def test_seeds_do_not_count_against_their_pattern(spark, seeds):
    rng = random.Random(4)
    found = seeds(rng)
    docs = [(i, f"It was here. Reach me: {next(found)} as of now, or ({next(found)}) later") for i in range(30)]
    docs += [(100 + i, f"Nothing more. Reach me: ref-{88340 + i} as of now") for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in P.find(df, P.patterns(df)).collect()}
    for doc, text in docs[30:]:
        start = text.index("ref-")
        assert got[doc] == f"id:{start}:{start + 9}"


def test_a_context_of_other_words_is_not_trusted(spark):
    found = emails(random.Random(5))
    docs = [(i, f"Reach me: {next(found)} as of now") for i in range(10)] + [(50 + i, "Reach me: tomorrow at noon") for i in range(10)] + [(100, "Reach me: ref-88340 now")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert P.patterns(df).count() == 0
    assert {r.doc_id: r.spans for r in P.find(df, P.patterns(df)).collect()}[100] == ""
