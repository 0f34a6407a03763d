"""Joins with declared shape: lookups, full joins with fill, history merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftplan.operators.columns import common_columns
from liftplan.operators.dedup import top1_per_key
from liftplan.operators.keyed import Keyed


#: Keys over which rows without details are spread.
FILLERS = 256


def _all(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def lookup(df: DataFrame | Keyed, dim: DataFrame | Keyed, on: Mapping[str, str], take: Mapping[str, str],
           how: str = "left", fill: bool | Sequence[str] = False,
           one_to_one: Sequence[Column | str] | None = None, details: bool = False) -> DataFrame | Keyed:
    """Equi-join a dimension and take some of its columns under new names.

    ``on``    column of ``df`` -> column of ``dim``.
    ``take``  result name -> column of ``dim``.
    ``fill``  result names that already exist in ``df`` and take the looked-up
              value only where they are null (True: all of them).
    ``one_to_one``  order that picks one dimension row per key, so the join
              cannot multiply rows.
    ``details``  ``dim`` is a detail table that may hold very many rows of one
              key. A left join is then built as one inner join, where Spark can
              split a hot key of either side: rows of ``df`` without details
              meet filler rows, spread over ``FILLERS`` keys. ``df`` is read once.

    The dimension's columns are renamed before the join, so one dimension can
    be looked up any number of times. No side is broadcast by hint: sizes seen
    at run time decide, and skewed keys are split there.

    A dimension with known keys (:class:`Keyed`) that is unique over the join
    columns gets the plain left join: it needs neither ``one_to_one`` nor
    ``details``, because a hot key can only be on the left, where Spark splits
    it. If ``df`` has known keys, so has the result.
    """
    if isinstance(df, Keyed):
        known = dim if isinstance(dim, Keyed) else Keyed(dim)
        if one_to_one is not None:
            known = known.best(list(on.values()), one_to_one)
        made = lookup(df.df, known, on, take, how, fill, None, details)
        filled = list(take) if fill is True else list(fill or ())
        lost = {n.lower() for n in filled}
        kept = Keyed(df.df, frozenset(k for k in df.keys if not k & lost))
        return kept.joined(made, known, on, {source: name for name, source in take.items() if name not in filled})
    if isinstance(dim, Keyed):
        if dim.unique_over(on.values()):
            one_to_one, details = None, False
        dim = dim.df
    if one_to_one is not None:
        dim = top1_per_key(dim, list(on.values()), one_to_one)
    filled = list(take) if fill is True else list(fill or ())
    keys = {left: f"__key_{i}" for i, left in enumerate(on)}
    taken = {name: f"__new_{name}" if name in filled else name for name in take}
    right = dim.select(
        *[F.col(on[left]).alias(k) for left, k in keys.items()],
        *[F.col(source).alias(taken[name]) for name, source in take.items()],
    )
    match = _all([F.col(left) == F.col(k) for left, k in keys.items()])
    if details and how == "left":
        joined = _with_fillers(df, right, keys)
    else:
        joined = df.join(right, match, how)
    if filled:
        joined = joined.withColumns({n: F.coalesce(F.col(n), F.col(taken[n])) for n in filled})
    return joined.drop(*keys.values(), *[taken[n] for n in filled])


def asked_for(dim: DataFrame, df: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``dim`` whose key some row of ``df`` has; ``on`` as in :func:`lookup`.

    For a large dimension of which a lookup needs a small part: its rows are shuffled once, by the lookup's key, and what is left needs no
    further shuffle for a distinct or for the lookup itself. ``df`` is read for its keys, so it should be a stored frame.
    """
    keys = {left: f"__asked_{i}" for i, left in enumerate(on)}
    asked = df.select(*[F.col(left).alias(k) for left, k in keys.items()]).distinct()
    return dim.join(asked, _all([F.col(on[left]) == F.col(k) for left, k in keys.items()]), "left_semi")


def rejoin(df: DataFrame, narrow: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole rows with what was looked up for their ``keys`` alone; a null is a key like any other.

    ``narrow`` comes from the distinct keys of ``df`` (or more) and left joins, so every row finds its key. The join is an inner one, in
    which Spark can split a hot key of either side, and the only one for which the whole rows are shuffled.
    """
    match = _all([F.col(k).eqNullSafe(F.col(f"__narrow_{k}")) for k in keys])
    return df.join(narrow.withColumnsRenamed({k: f"__narrow_{k}" for k in keys}), match, "inner").drop(*[f"__narrow_{k}" for k in keys])


def _with_fillers(df: DataFrame, right: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Left join as an inner join with filler rows; ``keys`` maps columns of ``df`` to those of ``right``."""
    names = list(keys.values())
    known = right.where(_all([F.col(k).isNotNull() for k in names]))
    marked = _marked(df, right, keys, "left", 0)
    rows = known.withColumn("__code_right", F.lit(-1).cast("long")).withColumns({f"__at_{i}": F.col(k) for i, k in enumerate(names)})
    rows = rows.unionByName(_fillers(df.sparkSession, "right", 0), allowMissingColumns=True)
    return marked.join(rows, _met_or_filler("left", "right", len(names), marked, rows), "inner").drop(*_marks("left", len(names)), *_marks("right", len(names)))


def _marks(side: str, n: int) -> list[str]:
    return [f"__code_{side}", *[f"__{'to' if side == 'left' else 'at'}_{i}" for i in range(n)]]


def _marked(df: DataFrame, other: DataFrame, keys: Mapping[str, str], side: str, first: int) -> DataFrame:
    """Rows with their code: -1 if ``other`` holds their key, else one of ``FILLERS`` numbers from ``first``, and their keys if it does.

    ``keys`` maps columns of ``df`` to those of ``other``. ``other`` is reduced to one row per key, so a hot key of ``df`` can be split.
    """
    code, *to = _marks(side, len(keys))
    present = other.where(_all([F.col(k).isNotNull() for k in keys.values()]))
    met = present.select(*[F.col(k).alias(t) for k, t in zip(keys.values(), to, strict=True)]).distinct().withColumn("__has", F.lit(True))
    marked = df.join(met, _all([F.col(c) == F.col(t) for c, t in zip(keys, to, strict=True)]), "left")
    spread = F.when(F.col("__has").isNull(), F.monotonically_increasing_id() % FILLERS + first).otherwise(F.lit(-1)).cast("long")
    return marked.withColumn(code, spread).drop("__has")


def _fillers(spark: SparkSession, side: str, first: int) -> DataFrame:
    """Rows with a code only, which rows without a partner meet."""
    return spark.range(first, first + FILLERS).toDF(f"__code_{side}")


def _met_or_filler(a: str, b: str, n: int, left: DataFrame, right: DataFrame) -> Column:
    (code_a, *to_a), (code_b, *to_b) = _marks(a, n), _marks(b, n)
    return _all([left[code_a] == right[code_b], *[left[x].eqNullSafe(right[y]) for x, y in zip(to_a, to_b, strict=True)]])


def full_join_fill(a: DataFrame, b: DataFrame, on: Mapping[str, str],
                   fill: Mapping[str, tuple[str, str]] | None = None,
                   unique_keys: bool = False) -> DataFrame:
    """Full join on computed or plain keys, then key fill.

    ``on`` maps columns of ``a`` to columns of ``b``; the frames must not share
    column names. ``fill`` maps a result name to the pair (column of ``a``,
    column of ``b``) it takes its first non-null value from.

    Spark cannot split a hot key in a full join. Each side's rows are marked
    with whether the other side holds their key (its distinct keys are all that
    is read of it for that); then one inner join, in which Spark splits a hot key of
    either side, lets rows with partners meet them and the others meet filler
    rows, spread over ``FILLERS`` codes per side. Whole rows of each input are read once.
    ``unique_keys`` says that no key repeats on either side; a plain full join
    then has no hot keys to fear.
    """
    clash = {c.lower() for c in a.columns} & {c.lower() for c in b.columns}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    match = _all([F.col(x) == F.col(y) for x, y in on.items()])
    if unique_keys:
        joined = a.join(b, match, "full")
    else:
        joined = _full_with_fillers(a, b, on)
    if fill:
        joined = joined.withColumns({n: F.coalesce(F.col(x), F.col(y)) for n, (x, y) in fill.items()})
    return joined


def _full_with_fillers(a: DataFrame, b: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Full join as one inner join: rows of ``a`` without partners have the codes of fillers of ``b``, and the other way round."""
    n = len(on)
    left = _marked(a, b, on, "left", 0).unionByName(_fillers(a.sparkSession, "left", FILLERS), allowMissingColumns=True)
    right = _marked(b, a, {y: x for x, y in on.items()}, "right", FILLERS).unionByName(_fillers(a.sparkSession, "right", 0), allowMissingColumns=True)
    return left.join(right, _met_or_filler("left", "right", n, left, right), "inner").drop(*_marks("left", n), *_marks("right", n))


def merge_newer(old: DataFrame, new: DataFrame, keys: Sequence[str],
                keep_history: bool = True, unique_keys: bool = False) -> DataFrame:
    """Merge two versions of a table; a new value wins where it is not null.

    ``keep_history=True`` keeps keys found only in ``old`` (a full join);
    ``False`` keeps the keys of ``new`` only (a right join). ``unique_keys``
    as in :func:`full_join_fill`.
    """
    shared = common_columns(new, old, keys)
    right = new.select(*keys, *shared)
    left = old.select(*[F.col(k).alias(f"__old_{k}") for k in keys],
                      *[F.col(c).alias(f"__old_{c}") for c in shared])
    match = _all([F.col(k) == F.col(f"__old_{k}") for k in keys])
    newest = [F.coalesce(F.col(c), F.col(f"__old_{c}")).alias(c) for c in [*keys, *shared]]
    if keep_history and unique_keys:
        return right.join(left, match, "full").select(*newest)
    merged = right.join(left, match, "left").select(*keys, *newest[len(keys):])
    if not keep_history:
        return merged
    gone = left.join(right.select(*keys).distinct(), match, "left_anti")
    return merged.unionByName(
        gone.select(*[F.col(f"__old_{c}").alias(c) for c in [*keys, *shared]]))
