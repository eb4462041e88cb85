"""Text, number and weight expressions. All are Columns, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocabulary import EMPTY_PICTURE

# space in the Unicode sense, which plain trim() doesn't know
_SPACE = r"(?U)^\s+|\s+$"
_TOGETHER = r"(?iU)\s+(?:feat\.?|ft\.?|featuring|with|&|/|x)\s+|\s*,\s*"


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, _SPACE, "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_tag(c: Column) -> Column:
    """Trimmed lower-case tag; null for junk: years and decades, and anything of two characters or fewer."""
    tag = F.lower(stripped(c))
    return F.when((F.length(tag) > 2) & ~tag.rlike(r"(?U)^\d{2,4}s?$"), tag)


def label_artist(label: Column) -> Column:
    """The artist part of a chart label: before the first spaced dash, else before the first dash, else all of it."""
    part = F.when(label.contains(" - "), F.substring_index(label, " - ", 1)).when(label.contains("-"), F.substring_index(label, "-", 1)).otherwise(label)
    return blank_to_null(stripped(part))


def label_track(label: Column) -> Column:
    """The track part of a chart label; null without a dash."""
    after = lambda sep: F.substring(label, F.locate(sep, label) + len(sep), F.length(label))
    return blank_to_null(stripped(F.when(label.contains(" - "), after(" - ")).when(label.contains("-"), after("-"))))


def headline_artist(name: Column) -> Column:
    """The first of several credited artists; joining words need white space around them, a comma doesn't."""
    return blank_to_null(stripped(F.split(stripped(name), _TOGETHER, 2)[0]))


def number(cell: Column) -> Column:
    """The first integer of a cell without its thousands separators; null where there is none."""
    return F.regexp_extract(F.replace(cell, F.lit(","), F.lit("")), r"-?\d+", 0).try_cast("bigint")


def tag_weight(count: Column, divisor: int = 20) -> Column:
    """Weight of a tag in the vote: its count scaled down, 1 at least and where the count isn't an integer."""
    return F.greatest(F.floor(F.coalesce(count.try_cast("bigint"), F.lit(divisor)) / divisor), F.lit(1)).cast("bigint")


def streams(daily: str = "daily_streams", weekly: str = "weekly_streams", total: str = "total_streams") -> Column:
    """The finest measure that a chart row has, else 0."""
    return F.coalesce(daily, weekly, total, F.lit(0)).cast("bigint")


def picture(medium: Column, big: Column) -> Column:
    """The medium picture, else the big one; the hash of an empty file means no picture."""
    real = lambda c: F.when(~c.contains(EMPTY_PICTURE), blank_to_null(c))
    return F.coalesce(real(medium), real(big))


def thumbnail(url: Column, width: int = 250) -> Column:
    """The picture's address over https and with a width."""
    safe = F.regexp_replace(url, "^(.*?)http://", "$1https://")
    return F.concat(safe, F.when(safe.contains("?"), "&").otherwise("?"), F.lit(f"width={width}"))


def summary(html: Column) -> Column:
    """A description without its trailing link and tags, ending in one full stop; null if nothing is left."""
    bare = F.regexp_replace(F.split(html, r"<a\s", 2)[0], "<[^>]+>", "")
    text = F.regexp_replace(bare, r"^[\s]+|[\s.]+$", "")
    return F.when(text != "", F.concat(text, F.lit(".")))


def year(value: Column) -> Column:
    """The year that a partial date starts with."""
    return F.regexp_extract(value, r"^\+*(\d{4})", 1).try_cast("bigint")


def origin(country: Column, area_codes: Column) -> Column:
    """Lower-case country code: the country itself, else the first code of its area."""
    return F.lower(F.coalesce(blank_to_null(country), F.try_element_at(area_codes, F.lit(1))))


def half_up(x: Column, digits: int = 1) -> Column:
    """Rounds halves towards plus infinity, as browsers do."""
    return F.floor(x * 10**digits + 0.5) / 10**digits


def share_band(percentage: Column, bands: int = 6) -> Column:
    """The index of an equal-width band of a percentage, clamped to 0-100."""
    inside = F.greatest(F.least(percentage, F.lit(100.0)), F.lit(0.0))
    return F.when(percentage.isNotNull(), F.least(F.floor(inside / 100 * bands), F.lit(bands - 1)).cast("int"))


def remainder(shown: Column) -> Column:
    """What is left of 100 percent, never negative."""
    return F.greatest(F.lit(0.0), F.round(100 - shown, 2))
