"""Best row per key, and the removal of repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int,
                  position: str) -> DataFrame:
    """The first ``n`` rows of each key with their position.

    A bounded row_number lets Spark cut every map task's rows to ``n`` per key
    before the shuffle, so a key that holds much of the table stays cheap.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(position, F.row_number().over(w)).where(F.col(position) <= n)


def top1_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                 tiebreak: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, ties settled by ``tiebreak``.

    Without ``tiebreak`` all other columns decide, in alphabetical order, so
    the result is the same on every run.
    """
    if tiebreak is None:
        key_set = {k.lower() for k in keys}
        tiebreak = sorted(c for c in df.columns if c.lower() not in key_set)
    return first_per_key(df, keys, [*order, *tiebreak], 1, "__position").drop("__position")


def distinct_subset(df: DataFrame, keys: Sequence[str],
                    order: Sequence[Column | str] = ()) -> DataFrame:
    """Distinct on some columns; ``order`` (then all columns) picks the row."""
    return top1_per_key(df, keys, order)


def keep_unmeasured(df: DataFrame, measures: Sequence[str], first_keys: Sequence[str],
                    first_order: Sequence[Column], second_keys: Sequence[str],
                    second_order: Sequence[Column], tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Two rounds of best-row-per-key that never lose rows without measures.

    A row whose measures are all null is kept whatever its rank. Any other row
    must win both rounds. Rows without measures still compete, as a ranking
    over the whole frame demands; where they share a key of nulls, the bounded
    row number leaves one of them per map task.
    """
    bare = F.lit(True)
    for m in measures:
        bare = bare & F.col(m).isNull()
    round_one = top1_per_key(df, first_keys, first_order, tiebreak)
    round_two = top1_per_key(round_one, second_keys, second_order, tiebreak)
    return round_two.where(~bare).unionByName(df.where(bare))
