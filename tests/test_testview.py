"""The warehouse tables of the test view: which lines are read, and what is written for them."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terroir import testview
from terroir.operators import genres as G

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture
def folder(spark, tmp_path):
    """The tables, with items of the two last years' orders only for some nations: their other days have orders without lines."""
    for name in ("nation", "supplier", "part", "customer", "orders"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{SF}/{name}.parquet")
    read = testview.tables(spark, SF)
    late = read("orders").where("o_orderdate >= '2000-01-01'").join(read("customer").where("c_nationkey % 4 = 1"), F.col("o_custkey") == F.col("c_custkey"))
    read("lineitem").join(late, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_recent_lines_reach_back_to_days_with_lines(spark, folder):
    every = testview.lines(spark, folder)
    newest = Window.partitionBy("country_code").orderBy(F.desc("snapshot_date"))
    days = every.select("country_code", "snapshot_date").distinct().withColumn("r", F.dense_rank().over(newest)).where("r <= 2")
    first = days.agg(F.min("snapshot_date")).first()[0]
    view = testview.View(spark, folder, recent=True)
    columns = sorted(every.columns)
    assert str(first) < "2000-01-01"
    assert sorted(map(tuple, view.lines.select(columns).collect())) == sorted(map(tuple, every.where(F.col("snapshot_date") >= F.lit(first)).select(columns).collect()))


def test_recent_figures_dont_write_all_lines(spark, folder):
    recent = testview.warehouse(spark, folder, recent=True)
    assert recent.country_artist_listeners.count() == testview.warehouse(spark, folder).country_artist_listeners.count() > 0
    assert not testview.warehouse(spark, folder).paths
    recent = testview.warehouse(spark, SF, recent=True)
    assert 0 < recent.chart_entries.count() < testview.lines(spark, SF).count() / 3
    assert max(spark.read.parquet(path).count() for path in recent.paths) < testview.lines(spark, SF).count() / 3


def test_tags_are_written_once_and_without_their_texts(spark, folder):
    view = testview.View(spark, folder, recent=False)
    assert G.coverage(view.scored[2], ["country_code"]).count() > 0
    assert view.country_genre_scores.count() > 0
    assert [sorted(spark.read.parquet(path).columns) for path in view.paths] == [
        ["artist_name", "bucket", "country_code", "snapshot_date", "source", "weight"],
        ["country_code", "distinctiveness", "genre", "score", "snapshot_date", "sources"],
    ]
