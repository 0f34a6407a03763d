"""Query registry: one callable and, where SQL can say the same, one SQL text per key."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftplan.session import tune
from liftplan.sources import Catalog, read_table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
AS_OF = "1998-06-15"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def name_scratch(spark: SparkSession) -> SparkSession:
    """Give a single-process session without a scratch folder one of its own, dropped at exit.

    A cluster has to name a shared folder in ``spark.checkpoint.dir``.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and re.match(r"local(\[|$)", context.master):
        folder = tempfile.mkdtemp(prefix="liftplan-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return spark


class Inputs:
    """The given tables of one folder, opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.catalog = Catalog.of_zone("parquet", folder, TABLES, ".parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        df = read_table(self.spark, self.catalog, name)
        setattr(self, name, df)
        return df

    @cached_property
    def items(self) -> DataFrame:
        from liftplan.suite.domain import items
        return items(self)

    @cached_property
    def domain(self) -> Catalog:
        from liftplan.suite.domain import domain_catalog
        return domain_catalog(self)


def wire(df: DataFrame) -> DataFrame:
    """Plain result types: whole numbers as bigint, decimals as double, dates as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, where sums may meet in any order."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c), digits) for c in doubles}) if doubles else df


def query(key: str, sql: str | None):
    """Register ``fn(inputs)`` under ``key`` with its SQL counterpart."""
    def register(fn: Callable[[Inputs], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return wire(fn(Inputs(name_scratch(tune(spark)), folder)))

        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return register
