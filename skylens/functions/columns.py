"""Small column-expression helpers used across operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skylens.functions.constants import EARTH_RADIUS_M


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c: str | Column) -> Column:
    """True for a non-null finite double (NaN and +-inf are not finite)."""
    x = col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def floor_long(c: str | Column) -> Column:
    """True floor as a long (negative values round down)."""
    return F.floor(col(c)).cast("long")


def aligned(c: str | Column, seconds: int) -> Column:
    """Start of the fixed ``seconds`` bin containing a numeric epoch time."""
    return (F.floor(col(c) / F.lit(seconds)) * F.lit(seconds)).cast("long")


def epoch_date(seconds: str | Column) -> Column:
    """UTC calendar date of an epoch-seconds value, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(col(seconds) / F.lit(86400)).cast("int"))


def haversine_m(lat1: str | Column, lon1: str | Column, lat2: str | Column, lon2: str | Column) -> Column:
    """Great-circle distance in metres; the inner term is clamped to [0, 1]."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dlat = p2 - p1
    dlon = F.radians(col(lon2) - col(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    a = F.least(F.lit(1.0), F.greatest(F.lit(0.0), a))
    return F.lit(EARTH_RADIUS_M * 2) * F.asin(F.sqrt(a))


def strip_whitespace(c: str | Column) -> Column:
    """Python-style ``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def without_nulls(*items: Column) -> Column:
    """Array of the different texts among ``items`` that aren't null.

    ``array_compact`` and ``array_sort`` call a lambda, and what a lambda's array is made of is never compiled.
    """
    return F.array_except(F.array(*items), F.array(F.lit(None).cast("string")))


def flag_array(*pairs: tuple[Column, str]) -> Column:
    """Sorted array of the flag names whose condition is true (null counts as false)."""
    return F.sort_array(without_nulls(*[F.when(cond, F.lit(name)) for cond, name in pairs]))
