"""Scalar column expressions (P-series of the inventory).

Every helper returns a ``Column`` made of built-in functions: no Python runs per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewright.config import PSI_MODERATE_BELOW, PSI_STABLE_BELOW, TIER_HIGH, TIER_MEDIUM


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: Column | str, digits: int = 4) -> Column:
    """numpy's ``round(x, n)``: half to even on the scaled double, ``rint(x * 10^n) / 10^n``.

    Spark's ``round`` goes through the decimal text of the double and disagrees with numpy on ties.
    """
    scale = float(10**digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def parse_yyyymmdd(c: Column | str) -> Column:
    """Integer or text ``yyyymmdd`` to a date; anything that is not a real calendar date becomes NULL."""
    return F.to_date(F.try_to_timestamp(_col(c).cast("string"), F.lit("yyyyMMdd")))


def as_date(c: Column | str, dtype: T.DataType) -> Column:
    """Normalise a date-like column of any source type to ``DateType``."""
    c = _col(c)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    return parse_yyyymmdd(c)


def flag(cond: Column) -> Column:
    """Boolean condition to 0/1 where an unknown (NULL) comparison counts as 0, as a NaN comparison does in pandas."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def category_text(c: Column | str) -> Column:
    """Category to text; missing and the texts ``nan``/``None`` become ``unknown``.

    Integers are cast to text before the NULL check, so a NULL never turns ``13`` into ``13.0``.
    """
    s = _col(c).cast("string")
    return F.when(s.isin("nan", "None"), F.lit("unknown")).otherwise(F.coalesce(s, F.lit("unknown")))


def decile(p: Column | str) -> Column:
    """``clip(ceil(10 p), 1, 10)`` on the unrounded probability; NULL stays NULL (``least`` would skip it)."""
    p = _col(p)
    return F.when(p.isNotNull(), F.least(F.greatest(F.ceil(p * 10).cast("int"), F.lit(1)), F.lit(10)))


def risk_tier(p: Column | str, high: float = TIER_HIGH, medium: float = TIER_MEDIUM) -> Column:
    p = _col(p)
    return F.when(p >= high, "high").when(p >= medium, "medium").otherwise("low")


def psi_band(psi: Column | str) -> Column:
    psi = _col(psi)
    return (
        F.when(psi < PSI_STABLE_BELOW, "stable")
        .when(psi < PSI_MODERATE_BELOW, "moderate_change")
        .otherwise("significant_shift")
    )


def hist_bin(p: Column | str, n_bins: int = 10) -> Column:
    """Histogram-view bin: ``width_bucket(p, 0, 1, n)``; p = 1.0 falls in bin n + 1, as in the SQL view."""
    return F.width_bucket(_col(p), F.lit(0.0), F.lit(1.0), F.lit(n_bins)).cast("int")


def psi_bin(p: Column | str, n_bins: int = 10) -> Column:
    """PSI bin 1..n: equal width with the last bin closed, ``least(floor(p n) + 1, n)``; NULL stays NULL."""
    p = _col(p)
    return F.when(p.isNotNull(), F.least(F.floor(p * n_bins).cast("int") + 1, F.lit(n_bins)))


def date_lit(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def ratio_half_up(num: Column | str, den: Column | str, digits: int = 4) -> Column:
    """``round(num / den, digits)`` half-up for non-negative integer counts, computed exactly in integer arithmetic
    (``floor((2 num 10^d + den) / (2 den)) / 10^d``), so no float representation decides a tie."""
    scale = 10**digits
    n = _col(num).cast("long")
    d = _col(den).cast("long")
    a = n * F.lit(2 * scale) + d
    b = d * F.lit(2)
    return F.call_function("div", a, b).cast("double") / F.lit(float(scale))


def ts_lit(value: dt.datetime) -> Column:
    """A wall-clock timestamp literal (``timestamp_ntz``), built from text so no time zone touches it."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
