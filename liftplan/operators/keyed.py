"""Frames with known unique keys.

A key is a set of columns whose values together stand in one row only. Nothing here looks at rows: keys are declared where a table is
named (``TableSpec.unique``, ``Catalog.bind``) and follow the steps that keep them, so that a distinct over a key can be left out and a
lookup knows that its dimension cannot multiply rows. Steps that are not listed here lose the keys, because they give a plain frame.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from liftplan.operators.dedup import top1_per_key

Keys = frozenset[frozenset[str]]


def key_set(keys: Iterable[Sequence[str]]) -> Keys:
    """Keys in lower case; a key that holds a smaller one is left out."""
    all_keys = {frozenset(c.lower() for c in k) for k in keys}
    return frozenset(k for k in all_keys if not any(other < k for other in all_keys))


@dataclass(frozen=True)
class Keyed:
    """A frame and its keys. The empty key says that the frame has one row at most."""

    df: DataFrame
    keys: Keys = frozenset()

    @property
    def columns(self) -> list[str]:
        return self.df.columns

    def unique_over(self, columns: Iterable[str]) -> bool:
        """No two rows agree on ``columns``."""
        have = {c.lower() for c in columns}
        return any(k <= have for k in self.keys)

    def where(self, condition: Column | str) -> Keyed:
        return Keyed(self.df.where(condition), self.keys)

    def select(self, *columns: str) -> Keyed:
        """Keys whose columns all stay."""
        have = {c.lower() for c in columns}
        return Keyed(self.df.select(*columns), frozenset(k for k in self.keys if k <= have))

    def renamed(self, names: Mapping[str, str]) -> Keyed:
        new = {old.lower(): name.lower() for old, name in names.items()}
        return Keyed(self.df.withColumnsRenamed(dict(names)), frozenset(frozenset(new.get(c, c) for c in k) for k in self.keys))

    def with_columns(self, columns: Mapping[str, Column]) -> Keyed:
        """A key with a column that is computed anew is lost."""
        changed = {c.lower() for c in columns}
        return Keyed(self.df.withColumns(dict(columns)), frozenset(k for k in self.keys if not k & changed))

    def drop(self, *columns: str) -> Keyed:
        gone = {c.lower() for c in columns}
        return self.select(*[c for c in self.df.columns if c.lower() not in gone])

    def distinct(self) -> Keyed:
        """No step at all where a key is known; else all columns together become one."""
        if self.keys:
            return self
        return Keyed(self.df.distinct(), key_set([self.df.columns]))

    def best(self, keys: Sequence[str], order: Sequence[Column | str], tiebreak: Sequence[Column | str] | None = None) -> Keyed:
        """One row per key, the first by ``order``; nothing to do where the key is known already."""
        if self.unique_over(keys):
            return self
        return Keyed(top1_per_key(self.df, keys, order, tiebreak), key_set([keys, *self.keys]))

    def joined(self, df: DataFrame, other: Keyed, on: Mapping[str, str], names: Mapping[str, str]) -> Keyed:
        """``df`` as the equi-join of this frame with ``other``: ``names`` are the columns of ``other`` that it kept, by their old name.

        A key of this frame stays one if ``other`` has one row per join key. Otherwise it takes a key of ``other`` with it whose columns
        outside the join key were kept.
        """
        if other.unique_over(on.values()):
            return Keyed(df, self.keys)
        there = {v.lower(): k.lower() for k, v in on.items()} | {k.lower(): v.lower() for k, v in names.items()}
        wider = [k | frozenset(there[c] for c in o) for k in self.keys for o in other.keys if all(c in there for c in o)]
        return Keyed(df, key_set(wider))


def frame(df: DataFrame | Keyed) -> DataFrame:
    return df.df if isinstance(df, Keyed) else df
