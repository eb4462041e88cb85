"""Fixed schemas of the warehouse tables and of the raw documents. Reads never infer a schema."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"STRING": T.StringType(), "BIGINT": T.LongType(), "DATE": T.DateType(), "DOUBLE": T.DoubleType(), "TIMESTAMP": T.TimestampType(), "ARRAY<STRING>": T.ArrayType(T.StringType())}


def _table(columns: str) -> T.StructType:
    """``name TYPE [NOT NULL]``, comma-separated; needs no session."""
    fields = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], not rest) for name, kind, *rest in fields])


#: name -> (schema, key columns, whether the table is a daily fact partitioned by snapshot_date)
TABLES: dict[str, tuple[T.StructType, tuple[str, ...], bool]] = {
    "countries": (_table("code STRING NOT NULL, name STRING NOT NULL"), ("code",), False),
    "country_snapshots": (_table("country_code STRING NOT NULL, snapshot_date DATE NOT NULL, artist_count BIGINT NOT NULL"), ("country_code", "snapshot_date"), True),
    "country_genre_scores": (
        _table("country_code STRING NOT NULL, genre STRING NOT NULL, score BIGINT NOT NULL, distinctiveness DOUBLE NOT NULL, sources ARRAY<STRING>, snapshot_date DATE NOT NULL"),
        ("country_code", "genre", "snapshot_date"),
        True,
    ),
    "country_top_artists": (_table("country_code STRING NOT NULL, artist_name STRING NOT NULL, rank BIGINT NOT NULL, snapshot_date DATE NOT NULL"), ("country_code", "snapshot_date", "rank"), True),
    "artists": (_table("artist_name STRING NOT NULL, mbid STRING, origin_country STRING, formed_year BIGINT, fans BIGINT, resolved_at TIMESTAMP"), ("artist_name",), False),
    "country_artist_listeners": (_table("country_code STRING NOT NULL, artist_name STRING NOT NULL, listeners BIGINT, snapshot_date DATE NOT NULL"), ("country_code", "artist_name", "snapshot_date"), True),
    "country_artist_genres": (_table("country_code STRING NOT NULL, genre STRING NOT NULL, artist_name STRING NOT NULL, snapshot_date DATE NOT NULL"), ("country_code", "genre", "artist_name", "snapshot_date"), True),
    "genres": (_table("genre STRING NOT NULL, summary STRING, url STRING, resolved_at TIMESTAMP"), ("genre",), False),
    "chart_entries": (
        _table(
            "country_code STRING NOT NULL, snapshot_date DATE NOT NULL, position BIGINT NOT NULL, artist_name STRING NOT NULL, track_name STRING,"
            " days_on_chart BIGINT, peak_position BIGINT, daily_streams BIGINT, weekly_streams BIGINT, total_streams BIGINT"
        ),
        ("country_code", "snapshot_date", "position"),
        True,
    ),
}

RAW_CHART = "country STRING, rows ARRAY<ARRAY<STRING>>"
RAW_LISTENERS = (
    "country STRING, artists ARRAY<STRUCT<name: STRING, listeners: STRING, mbid: STRING>>,"
    " tags_by_artist MAP<STRING, ARRAY<STRUCT<name: STRING, count: STRING>>>"
)
RAW_GENRES = "genres_by_artist MAP<STRING, ARRAY<STRING>>"
CAPTURED_ENTITIES = (
    "results STRUCT<bindings: ARRAY<STRUCT<mbid: STRUCT<value: STRING>, name: STRUCT<value: STRING>, item: STRUCT<value: STRING>,"
    " iso: STRUCT<value: STRING>, inception: STRUCT<value: STRING>, image: STRUCT<value: STRING>>>>"
)
CAPTURED_ARTISTS = "topartists STRUCT<artist: ARRAY<STRUCT<name: STRING, listeners: STRING, mbid: STRING>>>"
CAPTURED_TAGS = "toptags STRUCT<tag: ARRAY<STRUCT<name: STRING, count: BIGINT>>>"
