"""Text expressions and names, on the documented vectors."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from terroir.functions import text as X
from terroir.functions.names import name_key, similarity


def apply(spark, make, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").select("i", make(F.col("v")).alias("o")).collect()
    return [r.o for r in sorted(rows)]


@pytest.mark.parametrize(
    ("make", "values", "expected"),
    [
        (X.clean_tag, ["\u00a0Slow Waltz ", "70s", "1990s", "44", "ok", None, "", "Zither Core", "12345s"], ["slow waltz", None, None, None, None, None, None, "zither core", "12345s"]),
        (X.label_artist, ["Kite-Low Tide", "Half-Light - Two-Step", "Wren", None, "  ", " - lost"], ["Kite", "Half-Light", "Wren", None, None, None]),
        (X.label_track, ["Kite-Low Tide", "Half-Light - Two-Step", "Wren", None, "Kite - "], ["Low Tide", "Two-Step", None, None, None]),
        (X.headline_artist, ["Wren feat. Kite", "Wren FT Kite", "Wren Featuring Kite", "Wren with Kite", "Wren & Kite / Lund", "Kite, Wren", " Wren ", "Withers", None, "\t", "Wren x Kite", "Alexx"], ["Wren", "Wren", "Wren", "Wren", "Wren", "Kite", "Wren", "Withers", None, None, "Wren", "Alexx"]),
        (X.number, ["12,345,678", "+9,001", "-77", "(x3)", "5 of 6", None, "", " ", "-", "*"], [12345678, 9001, -77, 3, 5, None, None, None, None, None]),
        (X.tag_weight, ["80", "100", "5", "0", None, "x", "79.5"], [4, 5, 1, 1, 1, 1, 1]),
        (X.thumbnail, ["http://a/b.jpg", "https://a/b?x=1", None], ["https://a/b.jpg?width=250", "https://a/b?x=1&width=250", None]),
        (X.summary, ["A <b>loud</b> kind. <a href='x'>Read more</a>", " ... ", "", None], ["A loud kind.", None, None, None]),
        (X.year, ["1985-06", "+1985-01-01T00:00:00Z", "85", None], [1985, 1985, None, None]),
        (name_key, ["Arcángel", "  TWICE ", "T.W.I.C.E.", "Mø", None], ["arcangel", "twice", "t.w.i.c.e.", "mø", None]),
    ],
)
def test_vectors(spark, make, values, expected):
    assert apply(spark, make, values) == expected


def test_picture_and_bands(spark):
    empty = f"http://x/{X.EMPTY_PICTURE}/a.jpg"
    rows = spark.createDataFrame([(1, empty, "big"), (2, "medium", "big"), (3, empty, None), (4, "", "")], "i int, m string, b string")
    assert [r.p for r in rows.select("i", X.picture(F.col("m"), F.col("b")).alias("p")).orderBy("i").collect()] == ["big", "medium", None, None]
    codes = spark.createDataFrame([(1, "GB", ["FR"]), (2, "", ["FR", "DE"]), (3, None, []), (4, None, None)], "i int, c string, a array<string>")
    assert [r.o for r in codes.select("i", X.origin(F.col("c"), F.col("a")).alias("o")).orderBy("i").collect()] == ["gb", "fr", None, None]
    assert apply(spark, X.share_band, [-5.0, 0.0, 16.6, 16.7, 100.0, 140.0, None], "double") == [0, 0, 0, 1, 5, 5, None]
    assert apply(spark, X.half_up, [0.25, -0.25, 1.04], "double") == [0.3, -0.2, 1.0]


def test_similarity():
    found = {(a, b): round(similarity(a, b), 2) for a, b in [("hip-hop", "hip hop"), ("chiptune", "chip tune"), ("rnb", "r&b"), ("electronic", "electronica"), ("", ""), ("a", "")]}
    assert found == {("hip-hop", "hip hop"): 85.71, ("chiptune", "chip tune"): 94.12, ("rnb", "r&b"): 66.67, ("electronic", "electronica"): 95.24, ("", ""): 100.0, ("a", ""): 0.0}
