"""Column helpers for padded codes and business keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_zeros(c: Column | str) -> Column:
    """Remove leading zeros; a code of zeros only becomes the empty text."""
    return F.ltrim(_c(c), F.lit("0"))


def pad_code(c: Column | str, width: int) -> Column:
    """Zero-padded text form of a number."""
    return F.lpad(_c(c).cast("string"), width, "0")


def drop_text(c: Column | str, unwanted: str) -> Column:
    """Remove every occurrence of a fixed text."""
    return F.replace(_c(c), F.lit(unwanted), F.lit(""))


def cut(c: Column | str, start: int, length: int) -> Column:
    """Part of a code; positions count from 1."""
    return F.substring(_c(c), start, length)


def tail_from(c: Column | str, start: int) -> Column:
    """The text from a position to its end."""
    return F.substring(_c(c), F.lit(start), F.length(_c(c)))


def split_composite(c: Column | str, first: int = 10, second: int = 6) -> tuple[Column, Column]:
    """Cut a composite id into two codes, each without leading zeros."""
    return strip_zeros(cut(c, 1, first)), strip_zeros(cut(c, first + 1, second))


def composite_key(*columns: Column | str) -> Column:
    """Join codes into one key; a missing code counts as empty text."""
    return F.concat_ws("", *[_c(c) for c in columns])
