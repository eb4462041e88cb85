"""Tags to scores."""

from __future__ import annotations

import math
import random

import pytest

from terroir.functions.names import similarity
from terroir.operators import genres as G
from terroir.plans import refresh

TAGS = "country_code string, artist_name string, pos int, tag string, count string, source string"


def buckets_of(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "genre string")
    return {r.genre: r.bucket for r in G.bucketed(df).collect()}


def test_buckets(spark):
    expected = {"death metal": "death metal", "chicago drill": "drill", "gangster rap": "hip-hop", "uk grime": "grime", "uk breakbeat": "electronic", "tech house": "house", "minimal techno": "techno", "zzz-not-a-real-genre-qqq": "other", None: "other", "  ": "other", "brothercore": "other", "mandopopp": "mandopop"}
    assert buckets_of(spark, list(expected)) == expected


def test_normalised_tags(spark):
    terms = spark.createDataFrame([("chiptune", 0), ("electronica", 1), ("j-pop", 2)], "term string, priority int")
    tags = spark.createDataFrame([("Rap",), ("hiphop",), ("R&B",), ("chip tune",), ("j-pop",), ("80s",), (None,), ("qqqqqq",)], "tag string")
    found = {r.tag: r.genre for r in G.normalised_tags(tags, terms).collect()}
    assert found == {"Rap": "hip-hop", "hiphop": "hip-hop", "R&B": "rnb", "chip tune": "chiptune", "j-pop": "j-pop", "80s": None, None: None, "qqqqqq": "qqqqqq"}


def test_nearest_terms_equal_brute_force(spark):
    rng = random.Random(3)
    terms = sorted({"".join(rng.choice("abcde -") for _ in range(rng.randint(3, 12))).strip() or "abc" for _ in range(150)})
    texts = set()
    for t in terms:
        cut = rng.randrange(len(t))
        texts |= {t[:cut] + t[cut + 1 :], t[:cut] + rng.choice("abcxyz") + t[cut:], t}
    texts.discard("")
    for threshold in (85, 88):
        got = {r.text: r.term for r in G.nearest_terms(spark.createDataFrame([(t,) for t in texts], "text string"), spark.createDataFrame(list(zip(terms, range(len(terms)), strict=True)), "term string, priority int"), threshold).collect()}
        want = {}
        for t in texts:
            score, o, term = max((similarity(t, x), -i, x) for i, x in enumerate(terms))
            if score >= threshold:
                want[t] = term
        assert got == want


def test_vote_and_coverage(spark):
    tags = spark.createDataFrame([("jp", "A", 0, "hip hop", "80", "a"), ("jp", "A", 0, "hip-hop", None, "b"), ("us", "B", 0, "pop", "100", "a"), ("us", "B", 1, "80s", "100", "a"), ("us", "B", 5, "jazz", "100", "a")], TAGS)
    known = G.classified(tags)
    votes = {(r.country_code, r.genre): (r.score, r.sources) for r in G.vote(known, ["country_code"]).collect()}
    assert votes == {("jp", "hip-hop"): (5, ["a", "b"]), ("us", "pop"): (5, ["a"])}
    assert {tuple(r) for r in G.behind(known, ["country_code"]).collect()} == {("jp", "hip-hop", "A"), ("us", "pop", "B")}
    rates = {r.country_code: (r.total_tags, r.unclassified_tags, r.unclassified_rate) for r in G.coverage(known, ["country_code"]).collect()}
    assert rates == {"jp": (2, 0, 0.0), "us": (2, 1, 0.5)}


SCORES = "country_code string, genre string, score long"


def scored(spark, rows):
    return {(r.country_code, r.genre): r.distinctiveness for r in G.distinctiveness(spark.createDataFrame(rows, SCORES), ["country_code"]).collect()}


def test_distinctiveness(spark):
    rows = [(f"c{i:02}", "pop", 100) for i in range(20)] + [("c00", "bollywood", 20), ("c01", "bossa nova", 1)]
    got = scored(spark, rows)
    assert got["c00", "pop"] == 0.0
    assert got["c00", "bollywood"] == pytest.approx(20 * math.log(20), abs=1e-3)
    assert scored(spark, [("a", "rock", 1373), ("a", "bossa nova", 5), ("b", "rock", 1)])["a", "bossa nova"] == 0.0
    many = scored(spark, [(c, g, 100 * s) for c, g, s in rows])
    assert sorted(many, key=lambda k: (-many[k], k)) == sorted(got, key=lambda k: (-got[k], k))
    assert scored(spark, []) == {}


def test_document_frequency(spark):
    rows = spark.createDataFrame([("jp", "j-pop", 155), ("jp", "rock", 845), ("us", "j-pop", 1), ("us", "rock", 999), ("gb", "j-pop", 2), ("gb", "rock", 998), ("zz", "rock", 0)], SCORES)
    assert {r.genre: r.df for r in G.document_frequency(rows, ["country_code"]).collect()} == {"j-pop": 1, "rock": 3}


def test_quality_report(spark):
    rates = spark.createDataFrame([("a", 10, 9, 0.9), ("b", 10, 1, 0.1)], "country_code string, total_tags long, unclassified_tags long, unclassified_rate double")
    counts = spark.createDataFrame([("a", 3), ("b", 3), ("c", 0)], "country_code string, artist_count long")
    assert G.quality_report(rates, counts).first() == (3, 0.5, ["c"], ["a"])


def test_cleansing_takes_values_from_a_table(spark):
    """With a table of values the rows aren't read for them: the result is the same, but for a tag that the table lacks."""
    tags = spark.createDataFrame([("A", "x", 0, "iron", "40", "a"), ("A", "x", 1, "zinc", "20", "a"), ("B", "y", 0, "iron", None, "b"), ("B", "z", 0, "zinc", "80", "a")], TAGS)
    artists = spark.createDataFrame([("A", "x", 1), ("B", "y", 1)], "country_code string, artist_name string, rank bigint")
    countries = spark.createDataFrame([("A",), ("B",)], "code string")
    buckets = spark.createDataFrame([("iron", 0), ("zinc", 1)], "bucket string, priority int")
    none = spark.createDataFrame([], "keyword string, bucket string, priority int")

    def scores(values):
        given = {} if values is None else {"values": spark.createDataFrame([(v,) for v in values], "tag string")}
        found = refresh.cleanse(artists, tags, countries, None, buckets, none, fuzzy=False, **given)
        return sorted((r.country_code, r.genre, r.score) for r in found.scores.collect())

    assert scores(["iron", "zinc", "iron", "lead"]) == scores(None) == [("A", "iron", 2), ("A", "zinc", 1), ("B", "iron", 1)]
    assert scores(["iron"]) == [("A", "iron", 2), ("B", "iron", 1)]
