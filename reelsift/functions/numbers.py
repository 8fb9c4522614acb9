"""Guarded numbers: what can't be read, or isn't positive, is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+(_\d+)*\.?(\d+)?|\.\d+)([eE][+-]?\d+)?\s*$"


def number(x: Column) -> Column:
    """A double from text; anything but a plain decimal number is null (no suffixes such as "1d")."""
    s = x.cast("string")
    return F.when(s.rlike(_NUMBER), F.regexp_replace(F.trim(s), "_", "").try_cast("double"))


def positive(x: Column) -> Column:
    n = number(x)
    return F.when(n > 0, n)


def positive_int(x: Column) -> Column:
    return F.when(number(x) >= 1, F.floor(number(x)))


def ratio(x: Column) -> Column:
    """ "n/d" or a plain number; a zero or unreadable denominator gives null."""
    parts = F.split(x, "/", 2)
    top, bottom = number(parts[0]), number(F.get(parts, F.lit(1)))
    return F.when(F.contains(x, F.lit("/")), top / F.nullif(bottom, F.lit(0.0))).otherwise(number(x))


def stripped(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def rounded(x: Column, digits: int) -> Column:
    """Halves go to the even digit."""
    return F.bround(x, digits)


def band_score(x: Column, low: float, high: float, floor: float = 0.0, ceiling: float = 1.0) -> Column:
    """1 inside [low, high], falling in a line to 0 at ``floor`` and ``ceiling``."""
    below = clamp((x - floor) / (low - floor) if low > floor else F.lit(0.0))
    above = clamp((ceiling - x) / (ceiling - high) if ceiling > high else F.lit(0.0))
    return F.when(x < low, below).when(x > high, above).when(x.isNotNull(), 1.0)


def weighted_mean(parts: list[tuple[Column, float]]) -> Column:
    """Weights that are negative or sum to 0 are an error."""
    total = sum(w for _, w in parts)
    if min(w for _, w in parts) < 0 or total <= 0:
        raise ValueError("weights must not be negative, and their sum must be positive")
    out = F.lit(0.0)
    for x, w in parts:
        out = out + x * (w / total)
    return out
