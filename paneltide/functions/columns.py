"""Scalar column expressions shared by the operators.

Everything here returns a ``pyspark.sql.Column`` built from JVM-side
functions, so it stays inside whole-stage codegen.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paneltide.functions import constants as K

__all__ = [
    "col_or",
    "strip_ws",
    "safe_div",
    "year_start",
    "severity",
    "score_band",
    "score_tier",
    "to_iso2",
    "minmax_score",
    "growth_pct",
    "upper_or_low",
    "fixed_mean",
]


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Trim leading/trailing whitespace (tabs and newlines too, like ``str.strip``)."""
    return F.regexp_replace(col_or(c), r"^\s+|\s+$", "")


def safe_div(num: Column, den: Column) -> Column:
    """NULL instead of an error when the denominator is 0 or NULL (SAFE_DIVIDE)."""
    return F.try_divide(num, den)


def year_start(year: str | Column) -> Column:
    """DATE(year, 1, 1)."""
    return F.make_date(col_or(year).cast("int"), F.lit(1), F.lit(1))


def severity(z: str | Column,
             high: float = K.SEVERITY_HIGH,
             medium: float = K.SEVERITY_MEDIUM) -> Column:
    """HIGH when |z| >= high, MEDIUM when |z| >= medium, else LOW (NULL z -> LOW)."""
    az = F.abs(F.coalesce(col_or(z), F.lit(0.0)))
    return (F.when(az >= high, F.lit("HIGH"))
            .when(az >= medium, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def score_band(score: str | Column,
               high: float = K.BAND_HIGH, mid: float = K.BAND_MID) -> Column:
    """Ranking-table band: >= high top, >= mid middle, else bottom."""
    s = col_or(score)
    return (F.when(s >= high, F.lit("top"))
            .when(s >= mid, F.lit("middle"))
            .otherwise(F.lit("bottom")))


def score_tier(score: str | Column,
               high: float = K.TIER_HIGH, mid: float = K.TIER_MID) -> Column:
    """Radar tier: > high Strong, > mid Moderate, else Weak (strict, unlike the band)."""
    s = col_or(score)
    return (F.when(s > high, F.lit("Strong"))
            .when(s > mid, F.lit("Moderate"))
            .otherwise(F.lit("Weak")))


def to_iso2(code: str | Column) -> Column:
    """Statistics-office code -> ISO alpha-2 (only EL differs)."""
    c = col_or(code)
    expr = None
    for src, dst in K.CODE_TO_ISO2.items():
        expr = (F.when(c == src, F.lit(dst)) if expr is None
                else expr.when(c == src, F.lit(dst)))
    return expr.otherwise(c)


def minmax_score(x: Column, lo: Column, hi: Column, invert: bool = False,
                 digits: int = 1, default: float | None = K.NEUTRAL_SCORE) -> Column:
    """Min-max scaled score in [0, 100], rounded; ``default`` when undefined."""
    frac = safe_div(x - lo, F.nullif(hi - lo, F.lit(0)))
    raw = F.lit(100) * (F.lit(1) - frac) if invert else F.lit(100) * frac
    out = F.round(raw, digits)
    return F.coalesce(out, F.lit(default)) if default is not None else out


def growth_pct(cur: Column, prev: Column, digits: int = 2,
               invert: bool = False) -> Column:
    """Percent change vs ``prev`` (NULL when prev is 0 or NULL), rounded."""
    num = (prev - cur) if invert else (cur - prev)
    return F.round(safe_div(num, F.nullif(prev, F.lit(0))) * F.lit(100), digits)


def upper_or_low(c: str | Column) -> Column:
    return F.upper(F.coalesce(col_or(c), F.lit("LOW")))


def fixed_mean(c: str | Column, scale: int) -> Column:
    """Mean of a column holding values with ``scale`` decimals (a rounded mart
    column): the sum runs over exact integers, so the result does not depend
    on summation order, partitioning or engine. NULLs are skipped; NULL when
    no value is present."""
    x = col_or(c)
    f = 10 ** scale
    total = F.sum(F.round(x * F.lit(f)).cast("long")).cast("double")
    # one division: the correctly rounded value of the exact rational mean
    return total / (F.lit(float(f)) * F.count(x))
