"""Thresholds that carry meaning, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    tag_weight_divisor: int = 20
    tags_per_artist: int = 5
    fuzzy_canonical: int = 85
    fuzzy_bucket: int = 88
    present_share: float = 0.01
    promoted_share: float = 0.01
    rows_per_country: int = 100
    unclassified_alarm: float = 0.5
    min_coverage: float = 20.0


DEFAULTS = Params()
