"""Column helpers for measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from liftplan.functions.keys import _c


def safe_div(a: Column | str, b: Column | str) -> Column:
    """Quotient; null where the divisor is zero."""
    return F.try_divide(_c(a), _c(b) if isinstance(b, (Column, str)) else F.lit(b))


def thousandth(c: Column | str) -> Column:
    """kg to t, litres to cubic metres."""
    return _c(c) / F.lit(1000)


def number_or_null(c: Column | str, kind: str = "double") -> Column:
    """Text to number; text that is no number becomes null."""
    return _c(c).try_cast(kind)


def whole_up(c: Column | str) -> Column:
    return F.ceil(_c(c))


def whole_down(c: Column | str) -> Column:
    return F.floor(_c(c))


def exact(c: Column | str, scale: int = 2) -> Column:
    """Decimal form of a measure, so that sums do not depend on row order."""
    return _c(c).cast(f"decimal(18,{scale})")
