"""Named tables: where they live, how they are read, and the curated scan."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace as _copy
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftplan.operators.filters import date_text_range
from liftplan.operators.keyed import Keyed, key_set
from liftplan.session import hadoop_fs

#: A table replaced while it is read keeps its rows in a version folder that a pointer file names; scans skip both names.
POINTER, VERSION = "_current", "_version-"

FILE_FORMATS = ("parquet", "delta", "csv", "avro", "orc", "json")


@dataclass(frozen=True)
class TableSpec:
    """Format and place of one table.

    ``location`` is a path for file formats and a table name for ``jdbc``.
    For ``jdbc``, ``options`` carries url, driver and credentials from the
    caller; ``slice_column`` with its bounds makes the read parallel. A read
    in one task has to be asked for by ``slices=1``.
    ``unique`` lists the table's keys, each a tuple of columns. ``months``
    names for a ``yyyyMMdd`` text column the folder column (``yyyyMM``) that
    the table is partitioned by.
    """

    format: str
    location: str
    schema: T.StructType | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    slice_column: str | None = None
    slice_bounds: tuple[object, object] | None = None
    slices: int | None = None
    unique: Sequence[Sequence[str]] = ()
    months: Mapping[str, str] = field(default_factory=dict)

    def at(self, location: str) -> "TableSpec":
        return _copy(self, location=location)


class Catalog:
    """Table name to :class:`TableSpec`, or to a frame bound by the caller."""

    def __init__(self, tables: Mapping[str, TableSpec] | None = None):
        self._tables: dict[str, TableSpec] = dict(tables or {})
        self._frames: dict[str, DataFrame | Callable[[], DataFrame]] = {}
        self._unique: dict[str, Sequence[Sequence[str]]] = {}

    @classmethod
    def of_zone(cls, fmt: str, base: str, names: Sequence[str], suffix: str = "",
                schemas: Mapping[str, T.StructType] | None = None,
                unique: Mapping[str, Sequence[Sequence[str]]] | None = None) -> "Catalog":
        """All ``names`` in one zone: one format below one base path."""
        schemas, unique = schemas or {}, unique or {}
        return cls({n: TableSpec(fmt, f"{base.rstrip('/')}/{n}{suffix}", schemas.get(n), unique=unique.get(n, ())) for n in names})

    def add(self, name: str, spec: TableSpec) -> "Catalog":
        self._tables[name] = spec
        return self

    def bind(self, name: str, df: DataFrame | Callable[[], DataFrame], unique: Sequence[Sequence[str]] = ()) -> "Catalog":
        """Use ``df`` whenever ``name`` is read (derived or already open tables).

        A callable is asked once, on first use. ``unique`` as in :class:`TableSpec`.
        """
        self._frames[name] = df
        self._unique[name] = unique
        return self

    def unique(self, name: str) -> Sequence[Sequence[str]]:
        """Declared keys of a table; a bound frame has those it was bound with."""
        if name in self._frames:
            return self._unique[name]
        return self.spec(name).unique

    def frame(self, name: str) -> DataFrame | None:
        found = self._frames.get(name)
        if callable(found):
            found = self._frames[name] = found()
        return found

    def spec(self, name: str) -> TableSpec:
        if name not in self._tables:
            raise KeyError(f"table {name!r} is not in the catalog")
        return self._tables[name]

    def __contains__(self, name: str) -> bool:
        return name in self._tables or name in self._frames


def jdbc_options(spec: TableSpec) -> dict[str, str]:
    """Reader options of a database table, split over tasks if bounds are known."""
    options = {**spec.options, "dbtable": spec.location}
    split = spec.slice_column and spec.slice_bounds and (spec.slices or 0) > 1
    if not split and spec.slices != 1:
        raise ValueError(f"{spec.location}: give slice_column, slice_bounds and slices, or slices=1 for one task")
    if split:
        low, high = spec.slice_bounds
        options |= {
            "partitionColumn": spec.slice_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(spec.slices),
        }
    return options


@dataclass(frozen=True)
class Version:
    """A version of a file table. ``parts`` names for each partition folder the version folder that holds it; None: all are in its own."""

    name: str
    parts: Mapping[str, str] | None = None

    def folders(self) -> set[str]:
        """Version folders that hold rows of this version."""
        return {self.name} if self.parts is None else {self.name, *self.parts.values()}


#: Manifest of a version that shares partition folders with older ones, and the version name of files that lie in the table's own folder.
MANIFEST, PLAIN = "_parts", "."


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None if there is none."""
    fs, handle, jvm = hadoop_fs(spark, path)
    if not fs.exists(handle):
        return None
    stream = fs.open(handle)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def versions(spark: SparkSession, spec: TableSpec) -> list[tuple[str, float | None]]:
    """Versions that the pointer lists: the present one first (None), then older ones with the time (seconds) at which they were replaced."""
    text = read_text(spark, f"{spec.location.rstrip('/')}/{POINTER}") if spec.format not in ("delta", "jdbc") else None
    if text is None:
        return []
    lines = [line.split("\t") for line in text.splitlines() if line.strip()]
    return [(line[0].strip(), float(line[1]) if len(line) > 1 else None) for line in lines]


def live_version(spark: SparkSession, spec: TableSpec, name: str | None = None) -> Version | None:
    """The version of a pointer table that readers get now (or the one called ``name``); None for a table without a pointer."""
    if name is None:
        listed = versions(spark, spec)
        if not listed:
            return None
        name = listed[0][0]
    text = read_text(spark, f"{spec.location.rstrip('/')}/{name}/{MANIFEST}")
    return Version(name, None if text is None else json.loads(text))


def current(spark: SparkSession, spec: TableSpec) -> str:
    """Folder that new rows of a file table go to now."""
    live = live_version(spark, spec)
    return spec.location if live is None else f"{spec.location.rstrip('/')}/{live.name}"


def _load(reader, spec: TableSpec, live: Version | None) -> DataFrame:
    """Rows of a version. Partition folders that it shares with older versions are read where they lie, one scan per version folder."""
    base = spec.location.rstrip("/")
    if live is None or live.parts is None:
        return reader.load(base if live is None else f"{base}/{live.name}")
    held: dict[str, list[str]] = {}
    for part, folder in sorted(live.parts.items()):
        held.setdefault(folder, []).append(part)
    scans = [reader.option("basePath", f"{base}/{folder}").load([f"{base}/{folder}/{part}" for part in parts]) for folder, parts in sorted(held.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def read_table(spark: SparkSession, catalog: Catalog, name: str) -> DataFrame:
    """Open one catalog table lazily."""
    bound = catalog.frame(name)
    if bound is not None:
        return bound
    spec = catalog.spec(name)
    if spec.format == "jdbc":
        return spark.read.format("jdbc").options(**jdbc_options(spec)).load()
    if spec.format not in FILE_FORMATS:
        raise ValueError(f"unknown table format {spec.format!r}")
    reader = spark.read.format(spec.format)
    if spec.format == "csv":
        if spec.schema is None:
            raise ValueError(f"csv table {name!r} needs an explicit schema")
        reader = reader.option("header", "true")
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    return _load(reader.options(**spec.options), spec, live_version(spark, spec))


def curated_scan(
    spark: SparkSession,
    catalog: Catalog,
    name: str,
    where: Column | None = None,
    columns: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
    distinct: bool = True,
    read_at: datetime | str | None = None,
    text_dates: Mapping[str, tuple[Column | None, Column]] | None = None,
) -> DataFrame:
    """Filter, narrow, de-duplicate and rename one table.

    The filter and the column list stand before the distinct, so both reach
    the file scan. ``read_at`` adds a ``read_timestamp`` column. A table with a
    declared key among ``columns`` needs no distinct and gets none.
    ``text_dates`` keeps rows whose ``yyyyMMdd`` text lies between two dates
    (None: from the first); where the table has a month folder for that column
    (``TableSpec.months``), other folders are not listed or read.
    """
    return keyed_scan(spark, catalog, name, where, columns, rename, distinct, read_at, text_dates).df


def keyed_scan(
    spark: SparkSession,
    catalog: Catalog,
    name: str,
    where: Column | None = None,
    columns: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
    distinct: bool = True,
    read_at: datetime | str | None = None,
    text_dates: Mapping[str, tuple[Column | None, Column]] | None = None,
) -> Keyed:
    """:func:`curated_scan` with the keys that its rows are known to have."""
    months = {} if catalog.frame(name) is not None else catalog.spec(name).months
    rows = Keyed(read_table(spark, catalog, name), key_set(catalog.unique(name)))
    for column, (low, high) in (text_dates or {}).items():
        if column in months:
            rows = rows.where(month_folder_range(months[column], low, high))
        rows = rows.where(date_text_range(column, low, high))
    if where is not None:
        rows = rows.where(where)
    if columns is not None:
        rows = rows.select(*columns)
    elif months:
        rows = rows.drop(*months.values())
    if distinct:
        rows = rows.distinct()
    if rename:
        rows = rows.renamed(rename)
    if read_at is not None:
        rows = Keyed(stamp(rows.df, "read_timestamp", read_at), rows.keys)
    return rows


def month_folder_range(folder: str, low: Column | None, high: Column) -> Column:
    """``yyyyMM`` folder between the months of two dates."""
    month = F.col(folder).cast("string")
    test = month <= F.date_format(high, "yyyyMM")
    return test if low is None else (month >= F.date_format(low, "yyyyMM")) & test


def with_months(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` with the month folders of its text dates, for writing; texts too short for a month share a folder of their own."""
    if not spec.months:
        return df
    return df.withColumns({folder: F.substring(F.col(column), 1, 6) for column, folder in spec.months.items()})


def stamp(df: DataFrame, column: str, at: datetime | str | None) -> DataFrame:
    """Add a load time; the clock is read only if ``at`` is None."""
    value = F.current_timestamp() if at is None else F.lit(str(at)).cast("timestamp_ntz")
    return df.withColumn(column, value)


def patch_rows(df: DataFrame, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """Append hand-written rows by column name; columns not given are null."""
    if not rows:
        return df
    names = [c for c in df.columns if any(c in r for r in rows)]
    schema = T.StructType([T.StructField(n, df.schema[n].dataType, True) for n in names])
    extra = df.sparkSession.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    return df.unionByName(extra, allowMissingColumns=True)
