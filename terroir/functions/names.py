"""The few functions that built-in expressions can't give; Arrow batches, meant for distinct values."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _key(name: str | None) -> str | None:
    if name is None:
        return None
    plain = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return " ".join(plain.split()).casefold()


@F.pandas_udf(T.StringType())
def name_key(names: pd.Series) -> pd.Series:
    """Name without accents, case and surplus space; punctuation counts."""
    return names.map(_key, na_action="ignore")


def similarity(a: str, b: str) -> float:
    """Normalised Indel similarity, 200 * LCS / (length + length)."""
    if not a and not b:
        return 100.0
    # bit-parallel longest common subsequence: a zero bit is a matched place of a
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return 200.0 * (len(a) - row.bit_count()) / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")
