"""Predicates and null-safe row removal."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftplan.functions.dates import as_of_date, parse_yyyymmdd, text_yyyymmdd
from liftplan.functions.keys import _c


def in_list(c: Column | str, values: Sequence[object]) -> Column:
    return _c(c).isin(list(values))


def not_in(c: Column | str, values: Sequence[object]) -> Column:
    """Outside the list; a null is not kept."""
    return ~_c(c).isin(list(values))


def non_empty(c: Column | str) -> Column:
    """Neither null nor the empty text."""
    return F.length(_c(c)) != 0


def non_blank(c: Column | str) -> Column:
    """Neither null nor blanks only."""
    return F.length(F.trim(_c(c))) != 0


def missing(c: Column | str) -> Column:
    """Null or the empty text; never null itself."""
    return _c(c).isNull() | (F.length(_c(c)) == 0)


def in_period(c: Column | str, as_of: date | str | None, back_days: int = 100,
              until: int | str = "year_end") -> Column:
    """Date between ``back_days`` before the as-of date and an upper end.

    ``until`` is ``"year_end"``, ``"month_end"`` or a number of days ahead.
    """
    day = as_of_date(as_of)
    if until == "year_end":
        upper = F.make_date(F.year(day), F.lit(12), F.lit(31))
    elif until == "month_end":
        upper = F.last_day(day)
    else:
        upper = F.date_add(day, int(until))
    return _c(c).between(F.date_sub(day, back_days), upper)


def text_date_between(c: Column | str, low: str, high: str) -> Column:
    """Range test on ``yyyyMMdd`` text, compared as dates."""
    return date_text_range(c, F.lit(low).cast("date"), F.lit(high).cast("date"))


def date_text_range(c: Column | str, low: Column | None, high: Column) -> Column:
    """``yyyyMMdd`` text from ``low`` (None: from the first) to ``high``, both dates.

    The order of such texts is the order of their dates, so the plain text bounds in front reach the file scan; the parsed
    date behind them still turns malformed text away.
    """
    parsed = parse_yyyymmdd(c)
    test = (_c(c) <= text_yyyymmdd(high)) & (parsed <= high)
    return test if low is None else (_c(c) >= text_yyyymmdd(low)) & (parsed >= low) & test


def year_is(year: int, *columns: Column | str) -> Column:
    """Every given date lies in the year (as a range, so a scan can use it)."""
    first, after = F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year + 1}-01-01").cast("date")
    test = F.lit(True)
    for c in columns:
        test = test & (_c(c) >= first) & (_c(c) < after)
    return test


def covers(start: Column | str, end: Column | str, as_of: date | str | None) -> Column:
    """The as-of date lies between two dates."""
    return as_of_date(as_of).between(_c(start), _c(end))


def remove_where(df: DataFrame, pred: Column) -> DataFrame:
    """Drop the rows where ``pred`` is true; rows where it is null stay.

    Gives the rows of ``df.exceptAll(df.where(pred))`` without a shuffle.
    """
    return df.where(~F.coalesce(pred, F.lit(False)))
