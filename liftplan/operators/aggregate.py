"""Grouped measures. Every operator here combines on the map side first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftplan.operators.dedup import first_per_key


def sum_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Sums per key; a mapping gives result name -> measure."""
    named = measures if isinstance(measures, Mapping) else {m: m for m in measures}
    return df.groupBy(*keys).agg(*[F.sum(m).alias(n) for n, m in named.items()])


def summarise(df: DataFrame, keys: Sequence[str], avg: Mapping[str, str] | None = None,
              sum: Mapping[str, str] | None = None,
              count: Mapping[str, str] | None = None) -> DataFrame:
    """Averages, sums and counts of non-null values, each result name -> column."""
    parts = [F.avg(c).alias(n) for n, c in (avg or {}).items()]
    parts += [F.sum(c).alias(n) for n, c in (sum or {}).items()]
    parts += [F.count(c).alias(n) for n, c in (count or {}).items()]
    return df.groupBy(*keys).agg(*parts)


def concat_text(df: DataFrame, keys: Sequence[str], column: str, sep: str = ", ") -> DataFrame:
    """All non-null texts of a key in one text, in sorted order.

    Equal texts are counted before the shuffle and written out only in the
    result, so repeated texts travel once.
    """
    counted = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("__times"))
    pairs = F.array_sort(F.collect_list(
        F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("t"), F.col("__times").alias("n")))))
    texts = F.transform("__pairs", lambda p: F.array_join(F.array_repeat(p["t"], p["n"].cast("int")), sep))
    return (counted.groupBy(*keys).agg(pairs.alias("__pairs"))
            .select(*keys, F.array_join(texts, sep).alias(column)))


def concat_pieces(df: DataFrame, keys: Sequence[str], column: str, sep: str = ", ", piece_chars: int = 1 << 20) -> DataFrame:
    """The text of :func:`concat_text` in numbered pieces: keys, piece (from 0), text; joined by ``sep`` in order they are that text.

    For keys whose text is more than a task can hold. Rows are range-partitioned by key and text, so a large key lies in many partitions. Inside a
    partition texts are summed up in order and cut into pieces of about ``piece_chars`` characters; a single text is never cut. Pieces are
    numbered by partition and place, over pieces only. A key without any text has one empty piece.
    """
    rows = df.select(*keys, column).withColumn("__tie", F.monotonically_increasing_id())
    # The tie parts equal texts of one key.
    placed = rows.repartitionByRange(*keys, column, "__tie").withColumn("__part", F.spark_partition_id())
    inside = Window.partitionBy(*keys, "__part").orderBy(column, "__tie")
    before = F.sum(F.length(column) + len(sep)).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    numbered = placed.withColumn("__piece", F.coalesce(F.floor(before / piece_chars), F.lit(0)))
    # array_sort puts the texts of a piece, a bounded number of characters, back in order.
    pieces = numbered.groupBy(*keys, "__part", "__piece").agg(F.array_join(F.array_sort(F.collect_list(column)), sep).alias("__text"), F.count(column).alias("__n"))
    pieces = pieces.withColumn("__any", F.max("__n").over(Window.partitionBy(*keys)))
    full = pieces.where((F.col("__n") > 0) | (F.col("__any") == 0))
    order = F.row_number().over(Window.partitionBy(*keys).orderBy("__part", "__piece")) - 1
    numbered = full.withColumn("piece", order)
    return numbered.where((F.col("__any") > 0) | (F.col("piece") == 0)).select(*keys, "piece", F.col("__text").alias(column))


def nth_values(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
               take: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Values at fixed places of each key's ordered rows, counted from 0.

    ``take`` maps a result name to (column, place). Only the rows needed leave
    the map side; a place past the end gives null.
    """
    last = max(place for _, place in take.values())
    ranked = first_per_key(df, keys, order, last + 1, "__place")
    return ranked.groupBy(*keys).agg(*[
        F.max(F.when(F.col("__place") == place + 1, F.col(c))).alias(n)
        for n, (c, place) in take.items()])


def first_last(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str],
               first: str, last: str) -> DataFrame:
    """First and last value of each key by an explicit order."""
    by = F.struct(*order)
    return df.groupBy(*keys).agg(F.min_by(value, by).alias(first), F.max_by(value, by).alias(last))


def sum_over_duplicates(df: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """Group by every column and sum some of them (result name -> column)."""
    return df.groupBy(*df.columns).agg(*[F.sum(c).alias(n) for n, c in measures.items()])


def reconcile(**frames: DataFrame) -> DataFrame:
    """Row count of each named frame."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("frame"), "n_rows")
              for n, df in frames.items()]
    return reduce(DataFrame.unionByName, counts)
