"""Session settings and small plan helpers of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftplan.session import stage, tune
from liftplan.suite.registry import name_scratch

#: Rows with long texts go to Python in batches of so many bytes at most.
ARROW_BATCH_BYTES = 32 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Run-time settings of the operators; a local session without a shared folder gets one."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    return name_scratch(tune(spark))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def filled_bits(values: DataFrame, bits: int = 1 << 23) -> np.ndarray:
    """Bitmap of a fixed number of bits (1 MB) with the bit of every value of the only column (long) set.

    It thins out rows before a join: a row whose bit is clear meets no value. The driver holds the bitmap, never the values.
    """
    cell = F.pmod(F.col(f"`{values.columns[0]}`"), F.lit(bits))
    filled = np.zeros(bits // 8, np.uint8)
    for row in (values.select(cell.alias("cell")).groupBy((F.col("cell") / 32768).cast("int").alias("part"))
                .agg(F.expr("bitmap_construct_agg(cell % 32768)").alias("bits")).collect()):
        filled[row["part"] * 4096:(row["part"] + 1) * 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return filled


def bit_of(filled: np.ndarray, value: int) -> bool:
    """The value's bit is set."""
    cell = value % (8 * len(filled))
    return bool(filled[cell >> 3] >> (cell & 7) & 1)


def give_back() -> None:
    """Hand this worker process's freed memory back to the system; it lives on for the tasks of other steps."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not have, one for each wanted."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        free = f"__{name}"
        while free in taken:
            free += "_"
        taken.add(free)
        out.append(free)
    return out


__all__ = ["ARROW_BATCH_BYTES", "ascii_lower", "bit_of", "filled_bits", "free_names", "give_back", "prepare", "stage", "table"]
