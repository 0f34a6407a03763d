"""Column helpers for dates kept as text, month periods and write stamps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from liftplan.functions.keys import _c


def as_of_date(as_of: date | str | None) -> Column:
    """The date a rule counts from; None reads the clock."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def parse_yyyymmdd(c: Column | str) -> Column:
    """``yyyyMMdd`` text to date; anything else becomes null."""
    return F.try_to_date(_c(c), "yyyyMMdd")


def text_yyyymmdd(c: Column | str) -> Column:
    return F.date_format(_c(c).cast("date"), "yyyyMMdd")


def text_german(c: Column | str) -> Column:
    """Date as ``dd.MM.yyyy``."""
    return F.date_format(_c(c).cast("date"), "dd.MM.yyyy")


def period_key(c: Column | str) -> Column:
    """``yyyyMMdd`` text to the month period ``yyyy-MM``."""
    return F.concat(F.substring(_c(c), 1, 4), F.lit("-"), F.substring(_c(c), 5, 2))


def date_period(c: Column | str) -> Column:
    """Date to the month period ``yyyy-MM``."""
    return F.date_format(_c(c).cast("date"), "yyyy-MM")


def parse_hhmmss(c: Column | str) -> Column:
    """``HHmmss`` text to ``HH:mm:ss`` text."""
    return F.concat_ws(":", *[F.substring(_c(c), p, 2) for p in (1, 3, 5)])


def days_until(end: Column | str, as_of: date | str | None) -> Column:
    return F.datediff(_c(end), as_of_date(as_of))


def write_stamp(at: Column | str | None = None) -> Column:
    """Load time moved from UTC to a fixed offset of one hour east."""
    utc = F.current_timestamp() if at is None else F.lit(at).cast("timestamp_ntz") if isinstance(at, str) else at
    if at is None:
        return F.from_utc_timestamp(utc, "GMT+1")
    return F.convert_timezone(F.lit("UTC"), F.lit("GMT+1"), utc)
