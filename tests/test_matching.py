"""Candidates, captured answers, merges, captured pages, codes."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from terroir import schemas
from terroir.operators import matching as M
from terroir.plans import refresh
from terroir.sources import raw, sinks

CANDIDATES = "query string, pos int, id long, name string, nb_fan long, picture_medium string, picture_big string"


def test_best_candidates(spark):
    rows = [
        ("Ostrava Trio", 0, 1, "Ostrava Trio (live)", 900), ("Ostrava Trio", 1, 2, "Ostrava Trio", 12), ("Mr Lund", 0, 3, "M.R. Lund", 70), ("Mr Lund", 1, 4, "Mr Lunde", 80),
        ("Zofia Wren", 0, 5, "Zófia  Wren", 31), ("Kite", 0, 6, "Kite", 3), ("Kite", 1, 7, "KITE", 4000), ("Søren", 0, 8, "Soren", 500), ("Søren", 1, 9, "søren", 2),
        ("Pale", 0, 10, "Pale", None), ("Pale", 1, 11, "pale ", 1), ("Gone", 0, 12, None, 1), ("Even", 0, 13, "Even", 6), ("Even", 1, 14, "EVEN", 6),
    ]
    found = {r.query: r.id for r in M.best_candidates(spark.createDataFrame([(*r, None, None) for r in rows], CANDIDATES)).collect()}
    assert found == {"Ostrava Trio": 2, "Zofia Wren": 5, "Kite": 7, "Søren": 9, "Pale": 11, "Even": 13}


def test_captured_entities(spark):
    value = lambda **k: {n: {"value": v} for n, v in k.items()}
    answer = {"results": {"bindings": [
        value(mbid="m1", name="One", item="Q1", iso="GB", inception="1985-01-01T00:00:00Z", image="http://i/1.jpg"), value(mbid="m1", name="One", item="Q1", iso="US"),
        value(mbid="m2", name="Two", item="Q2"), value(name="Two", item="Q3", iso="FR"), value(mbid="m3", image="https://i/3?x=1"), value(mbid="m3", image="http://i/4"),
    ]}}
    rows = M.bindings(spark.createDataFrame([(json.dumps(answer),)], "raw string").select(F.from_json("raw", schemas.CAPTURED_ENTITIES).alias("p")).select("p.*"))
    assert {r.mbid: (r.origin_country, r.formed_year) for r in M.entity_meta(rows, "mbid").collect()} == {"m1": ("gb", 1985), "m2": (None, None), "m3": (None, None)}
    assert {r.name: r.origin_country for r in M.entity_meta_by_name(rows).collect()} == {"One": "gb"}
    assert {r.mbid: r.image for r in M.entity_images(rows).collect()} == {"m1": "https://i/1.jpg?width=250", "m3": "https://i/3?x=1&width=250"}
    empty = spark.createDataFrame([("{}",)], "raw string").select(F.from_json("raw", schemas.CAPTURED_ENTITIES).alias("p")).select("p.*")
    assert M.bindings(empty).count() == 0


PAGE = """<html><table class="c"><tr><th>No</th></tr>
<tr><td>4</td><td>-2</td><td><a href="p">Wren &amp; Co</a>-Low-Tide</td><td>12</td><td>3</td><td>(x5)</td><td>7,654</td><td>-321</td><td>54,321</td><td>*</td><td>1,234,567</td></tr>
<tr></tr><tr><td>5</td><td>NEW</td><td> Kite - A - B </td></tr><tr><td>6</td><td>y</td></tr></table><table><tr><td>h</td></tr><tr><td>1</td><td>1</td><td>second-table</td></tr></table>"""


def test_chart_pages(spark):
    pages = spark.createDataFrame([("us", PAGE), ("xx", "<p>nothing</p>"), ("yy", None), ("zz", "<table></table>")], "country_code string, html string")
    got = sorted(tuple(r) for r in raw.chart_pages(pages).select("country_code", "position", "artist_name", "track_name", "peak_position", "daily_streams", "weekly_streams", "total_streams").collect())
    assert got == [("us", 4, "Wren & Co", "Low-Tide", 3, 7654, 54321, 1234567), ("us", 5, "Kite", "A - B", None, None, None, None)]


def test_raw_documents(spark, tmp_path):
    (tmp_path / "charts").mkdir()
    (tmp_path / "charts/us.json").write_text(json.dumps({"country": "US", "rows": [["1", "=", "A-b"], ["-", "=", "C-d"], ["2"]]}))
    (tmp_path / "tags").mkdir()
    (tmp_path / "tags/us.json").write_text(json.dumps({"country": "US", "artists": [{"name": "A", "listeners": "12", "mbid": ""}], "tags_by_artist": {"A": [{"name": "pop", "count": 80}]}}))
    (tmp_path / "list.txt").write_text(" pop \n\nrock\n")
    assert [(r.country_code, r.position, r.artist_name) for r in raw.typed_chart(raw.chart_documents(spark, str(tmp_path / "charts"))).collect()] == [("us", 1, "A")]
    docs = raw.listener_documents(spark, str(tmp_path / "tags"))
    assert [tuple(r) for r in raw.listener_rows(docs).collect()] == [("us", "A", 12, None, 0)]
    assert [tuple(r) for r in raw.tag_rows(docs, "a").collect()] == [("us", "A", 0, "pop", "80", "a")]
    assert [r.term for r in raw.ordered_lines(spark, str(tmp_path / "list.txt")).orderBy("priority").collect()] == ["pop", "rock"]
    assert raw.ordered_lines(spark, str(tmp_path / "none.txt")).count() == 0
    assert raw.read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0


def test_resolve_keeps_errors_pending(spark):
    pending = spark.createDataFrame([("A",), ("B",), ("C",), ("D",), ("E",)], "artist_name string")
    mbids = spark.createDataFrame([("A", "", 0), ("A", "m1", 1), ("E", "m1", 0)], "artist_name string, mbid string, pos int")
    by_id = spark.createDataFrame([("m1", "gb", 1985)], "mbid string, origin_country string, formed_year long")
    by_name = spark.createDataFrame([("B", "fr", None)], "name string, origin_country string, formed_year long")
    searched = spark.createDataFrame([("C", None, None, None, True), ("D", None, None, None, False)], "artist_name string, mbid string, origin_country string, formed_year long, failed boolean")
    got = {r.artist_name: (r.mbid, r.origin_country, r.status) for r in M.resolve(pending, mbids, by_id, by_name, searched).collect()}
    assert got == {"A": ("m1", "gb", "hit"), "E": ("m1", "gb", "hit"), "B": (None, "fr", "hit"), "C": (None, None, "error"), "D": (None, None, "miss")}


def test_merge_owns_columns(spark, tmp_path):
    path = str(tmp_path / "artists")
    names = spark.createDataFrame([("A",), ("B",)], "artist_name string")
    sinks.merge_dimension(names, path, "artists")
    refresh.store_resolved(spark.createDataFrame([("A", "m", "gb", 1985, "hit"), ("B", None, None, None, "error")], "artist_name string, mbid string, origin_country string, formed_year long, status string"), str(tmp_path), "2001-01-01")
    sinks.merge_dimension(spark.createDataFrame([("A", 0), ("C", 7)], "artist_name string, fans long"), path, "artists", ["fans"])
    rows = {r.artist_name: (r.origin_country, r.fans, r.resolved_at is not None) for r in sinks.read_table(spark, path, "artists").collect()}
    assert rows == {"A": ("gb", 0, True), "B": (None, None, False), "C": (None, 7, False)}
    with pytest.raises(Exception, match="repeated key"):
        sinks.merge_dimension(spark.createDataFrame([("A", 1), ("A", 2)], "artist_name string, fans long"), path, "artists", ["fans"])


def test_replace_day(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    day = lambda rows: spark.createDataFrame(rows, "country_code string, artist_count long")
    sinks.replace_day(day([("us", 1)]), path, "country_snapshots", "2001-01-01")
    sinks.replace_day(day([("us", 2)]), path, "country_snapshots", "2001-01-02")
    sinks.replace_day(day([("us", 3), ("gb", 4)]), path, "country_snapshots", "2001-01-02")
    got = sorted((str(r.snapshot_date), r.country_code, r.artist_count) for r in sinks.read_table(spark, path, "country_snapshots").collect())
    assert got == [("2001-01-01", "us", 1), ("2001-01-02", "gb", 4), ("2001-01-02", "us", 3)]
    sinks.replace_day(day([]), path, "country_snapshots", "2001-01-02")
    assert [str(r.snapshot_date) for r in sinks.read_table(spark, path, "country_snapshots").collect()] == ["2001-01-01"]


def test_create_tables_twice(spark):
    sinks.create_tables(spark, "market_test")
    sinks.create_tables(spark, "market_test")
    assert spark.sql("SHOW TABLES IN market_test").count() == 9
