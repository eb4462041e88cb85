"""Look-up rounds, counters, file order, stored days, raw documents and fuzzy candidates."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from terroir.functions.names import similarity
from terroir.operators import charts as C
from terroir.operators import genres as G
from terroir.operators import lookups
from terroir.operators import matching as M
from terroir.plans import market, refresh
from terroir.sources import raw, sinks

ANSWER = "city string, size bigint"


def rounds(spark, root, names, version, answers):
    """One round; gives what was asked, and (answer, status) by name."""
    asked = []

    def ask(pending):
        asked.extend(sorted(r.name for r in pending.collect()))
        return spark.createDataFrame([(n, *answers[n]) for n in asked], f"name string, {ANSWER}, failed boolean")

    wanted = spark.createDataFrame([(n,) for n in names], "name string")
    found = lookups.round_of(wanted, f"{root}/results", version, ANSWER, ask, str(root))
    return asked, {r.name: (r.city, r.size, r.status) for r in found.collect()}


def test_lookups_ask_only_what_is_open(spark, tmp_path):
    first = {"a": ("x", 1, False), "b": (None, None, False), "c": (None, None, True)}
    assert rounds(spark, tmp_path, ["a", "b", "c", "a", None], 1, first) == (["a", "b", "c"], {"a": ("x", 1, "hit"), "b": (None, None, "miss"), "c": (None, None, "error")})
    second = {"c": (None, 7, False), "d": ("y", None, False)}
    assert rounds(spark, tmp_path, ["a", "b", "c", "d"], 1, second) == (["c", "d"], {"a": ("x", 1, "hit"), "b": (None, None, "miss"), "c": (None, 7, "hit"), "d": ("y", None, "hit")})
    # a newer rule asks again; what it couldn't answer has no answer, though an older entry is still in the table
    third = {"a": (None, None, True), "b": ("z", 2, False)}
    assert rounds(spark, tmp_path, ["a", "b"], 2, third) == (["a", "b"], {"a": (None, None, "error"), "b": ("z", 2, "hit")})
    table = {r.name: (r.name_key, r.rule_version, r.city) for r in lookups.entries(spark, f"{tmp_path}/results", ANSWER).collect()}
    assert {n: v[1:] for n, v in table.items()} == {"a": (1, "x"), "b": (2, "z"), "c": (1, None), "d": (1, "y")}
    assert table["a"][0] == "0cc175b9c0f1b6a831c399e269772661"
    assert rounds(spark, tmp_path, [], 2, {}) == ([], {})


def test_lookups_refuse_wrong_answers(spark, tmp_path):
    wanted = spark.createDataFrame([("a",)], "name string")
    for answers in ([("b", "x", 1, False)], [("a", "x", 1, False), ("a", "y", 1, False)]):
        with pytest.raises(Exception, match="wasn't asked|repeated key"):
            lookups.round_of(wanted, f"{tmp_path}/t", 1, ANSWER, lambda _, rows=answers: spark.createDataFrame(rows, f"name string, {ANSWER}, failed boolean"), str(tmp_path))
    assert lookups.entries(spark, f"{tmp_path}/t", ANSWER).count() == 0


def test_counters_come_with_the_write(spark, tmp_path):
    counters = sinks.Counters()
    rows = spark.range(1000).repartition(7)
    watched = counters.over("some", rows, even=F.col("id") % 2 == 0)
    spark.sparkContext.setJobGroup("counted", "the only job")
    sinks.swap_in(watched, f"{tmp_path}/t")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("counted")
    assert counters.found == {"some": {"rows": 1000, "even": 500}}
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) == list(jobs)
    empty = sinks.Counters()
    sinks.swap_in(empty.over("none", rows.where("id < 0"), even=F.col("id") > 0), f"{tmp_path}/e")
    assert empty.found == {"none": {"rows": 0, "even": 0}}


def test_ids_in_file_order(spark, tmp_path):
    files = {"b": [("one", "m2"), ("two", ""), ("three", "m3"), ("three", "m9")], "a": [("one", ""), ("two", None), (None, "m0"), ("", "m8")], "c": [("one", "m1"), ("two", "m4"), ("four", "")]}
    for name, artists in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps({"country": name, "artists": [{"name": n, "mbid": m} for n, m in artists]}))
    rows = raw.ids_in_file_order(spark, str(tmp_path))
    assert {r.artist_name: r.mbid for r in M.first_mbid(rows, "place").collect()} == {"one": "m2", "two": "m4", "three": "m3", "four": None}
    assert {r.artist_name: (r.mbid, r.place.file) for r in C.dedupe_first(rows.where("mbid is not null"), ["artist_name"], "place").collect()} == {"one": ("m2", "b.json"), "two": ("m4", "c.json"), "three": ("m3", "b.json")}


def test_documents_have_their_names(spark, tmp_path):
    path = str(tmp_path / "docs")
    for text in ("old", "new"):
        sinks.write_documents(spark.createDataFrame([("NATION_1", f'{{"rows": [["1", "=", "A - {text}"]]}}'), ("x y", '{"rows": []}')], "name string, document string"), path)
    assert [tuple(r) for r in raw.typed_chart(raw.chart_documents(spark, path)).select("country_code", "track_name").collect()] == [("NATION_1", "new")]
    assert sorted(p.name for p in (tmp_path / "docs").iterdir() if p.suffix == ".json") == ["NATION_1.json", "x y.json"]


def test_a_day_and_its_report_are_one(spark, tmp_path):
    path = str(tmp_path / "days")
    day = lambda n: {"records": spark.createDataFrame([("us", n)], "country_code string, n int"), "quality": spark.createDataFrame([(n,)], "countries bigint")}
    assert sinks.stored(spark, path, "quality", "countries bigint").count() == 0
    sinks.store_day(day(1), path, "2001-01-01")
    sinks.store_day(day(2), path, "2001-01-02")
    broken = day(3) | {"quality": spark.range(1).select(F.raise_error(F.lit("lost")).cast("bigint").alias("countries"))}
    with pytest.raises(Exception, match="lost"):
        sinks.store_day(broken, path, "2001-01-02")
    for name, schema, column in (("records", "country_code string, n int", "n"), ("quality", "countries bigint", "countries")):
        assert sorted((str(r.snapshot_date), r[column]) for r in sinks.stored(spark, path, name, schema).collect()) == [("2001-01-01", 1), ("2001-01-02", 2)]


def test_fuzzy_candidates_are_few_and_whole(spark):
    rng = random.Random(7)
    nouns = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 9))) for _ in range(30)]
    terms = sorted({f"{a} {b}" for a in nouns for b in nouns})[:400]
    texts = sorted({t[: (cut := rng.randrange(len(t)))] + rng.choice(["", "z", "ab"]) + t[cut + rng.randint(0, 1) :] for t in terms})
    for threshold in (92, 85, 60):
        some = texts[:: 1 if threshold > 80 else 20]
        a, b = spark.createDataFrame([(t,) for t in some], "text string"), spark.createDataFrame(list(zip(terms, range(len(terms)), strict=True)), "term string, priority int")
        pairs = {(r.text, r.term) for r in G.near_pairs(a, b, threshold).collect()}
        want = {(t, x) for t in some for x in terms if similarity(t, x) >= threshold}
        assert want <= pairs
        assert len(pairs) <= 10 * len(want)


def test_containment_in_all_lengths(spark):
    buckets = spark.createDataFrame([("a", 0), ("bc", 1), ("cde", 2), ("cdef", 3), ("é", 4), ("a b", 5)], "bucket string, priority int")
    none = spark.createDataFrame([], "keyword string, bucket string, priority int")
    texts = ["xa", "BC", "xcdefx", "xcdex", "é!", "a b", " a  b", "zzz", "", None]
    found = {r.genre: r.bucket for r in G.bucketed(spark.createDataFrame([(t,) for t in texts], "genre string"), buckets, none, fuzzy=False).collect()}
    assert found == {"xa": "a", "BC": "bc", "xcdefx": "cdef", "xcdex": "cde", "é!": "é", "a b": "a b", " a  b": "a", "zzz": "other", "": "other", None: "other"}


def test_nothing_published_yet(spark, tmp_path):
    for family in refresh.PAYLOADS:
        assert refresh.published(spark, str(tmp_path), family).count() == 0
    assert market.flattened(refresh.published(spark, str(tmp_path), "countries")).count() == 0


def test_seeds_attributes_and_captured_answers(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("lastfm_name,code,name\nUnited Kingdom,gb,Britain\n,xx,Nowhere\n")
    assert [tuple(r) for r in raw.seed_countries(spark, str(tmp_path / "seed.csv")).collect()] == [("United Kingdom", "gb", "Britain"), (None, "xx", "Nowhere")]
    (tmp_path / "fans.json").write_text(json.dumps({"Wren": {"nb_fan": 5, "picture_big": "b"}, "Kite": {"nb_fan": None}}))
    known = raw.attributes(spark, str(tmp_path / "fans.json"), "STRUCT<nb_fan: BIGINT, picture_big: STRING>")
    assert sorted((r.artist_name, r.attributes.nb_fan, r.attributes.picture_big) for r in known.collect()) == [("Kite", None, None), ("Wren", 5, "b")]
    answers = [json.dumps({"topartists": {"artist": [{"name": "Wren", "listeners": "12", "mbid": "", "url": "u"}, {"name": "Kite", "listeners": "n/a", "mbid": "m"}]}}), "{}", "no json", None]
    got = raw.top_artists(spark.createDataFrame([(a,) for a in answers], "raw string"))
    assert [tuple(r) for r in got.collect()] == [(0, "Wren", 12, None), (1, "Kite", None, "m")]
    tags = raw.top_tags(spark.createDataFrame([(json.dumps({"toptags": {"tag": [{"name": "pop", "count": 80, "url": "u"}]}}),)], "raw string"))
    assert [tuple(r) for r in tags.collect()] == [(0, "pop", 80)]


def test_append_keeps_the_schema(spark, tmp_path):
    rows = spark.createDataFrame([("us", "2001-01-01", 3, "x")], "country_code string, snapshot_date string, artist_count int, other string")
    for _ in range(2):
        sinks.append(rows, f"{tmp_path}/t", "country_snapshots")
    got = sinks.read_table(spark, f"{tmp_path}/t", "country_snapshots")
    assert sorted(got.columns) == ["artist_count", "country_code", "snapshot_date"] and [(r.country_code, str(r.snapshot_date), r.artist_count) for r in got.collect()] == [("us", "2001-01-01", 3)] * 2
    with pytest.raises(ValueError, match="needs country_code"):
        sinks.append(rows.drop("country_code"), f"{tmp_path}/t", "country_snapshots")
