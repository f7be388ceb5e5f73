"""Numeric column functions and casts (MATH-1..3, CAST-1..2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reciprocal_or_self(x: Column | str) -> Column:
    """MATH-1: ``1/x``; ``x`` itself when it is 0; NULL stays NULL.

    ``CASE WHEN`` only evaluates the chosen branch, so ANSI mode never sees
    the division by zero.
    """
    x = _col(x).cast("double")
    return F.when(x != 0, F.lit(1.0) / x).otherwise(x)


def percent_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """MATH-2: ``a / b * 100``; NULL (not an error or inf) when ``b`` is 0."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double")) * 100


def round_half_even(x: Column | str, digits: int = 2) -> Column:
    """MATH-3: round half-to-even on the scaled double (``rint(x*10^d)/10^d``).

    This is the pandas/NumPy ``round`` rule; Spark's ``round`` rounds half up
    and ``bround`` rounds the decimal value, both of which differ on ties.
    """
    scale = float(10 ** digits)
    return F.rint(_col(x) * scale) / scale


def to_text(c: Column | str) -> Column:
    """CAST-1: to string; NULL stays NULL."""
    return _col(c).cast("string")


def no_nan(c: Column | str) -> Column:
    """NaN to NULL: a NaN would rank above every number in ``max``."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def to_double_strict(c: Column | str) -> Column:
    """CAST-2: to DOUBLE, raising on bad text (ANSI cast); NaN text is NULL."""
    return no_nan(_col(c).cast("double"))


def to_double_or_null(c: Column | str) -> Column:
    """CAST-2 variant for quarantine: bad text and NaN text -> NULL."""
    return no_nan(_col(c).try_cast("double"))


def exact_money(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """Money as an exact decimal, so sums do not depend on addition order."""
    return _col(c).cast(f"decimal({precision},{scale})")
