"""Merge of the current result into its history table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftplan.operators.aggregate import reconcile
from liftplan.operators.joins import merge_newer
from liftplan.sources import Catalog, counted, merge_partitions, read_table, safe_replace

SUMMARY_KEYS = ("key",)
MAPPING_KEYS = ("material_document_number", "contract_no", "material_number")


def run(spark: SparkSession, catalog: Catalog, current: str, history: str, keys: Sequence[str],
        keep_history: bool = True, unique_keys: bool = False) -> dict[str, DataFrame]:
    """``merged`` rows and the row ``counts`` of all three frames."""
    new, old = read_table(spark, catalog, current), read_table(spark, catalog, history)
    merged = merge_newer(old, new, keys, keep_history, unique_keys)
    return {"merged": merged, "counts": reconcile(current=new, history=old, merged=merged)}


def run_summary(spark: SparkSession, catalog: Catalog, current: str = "contract_summary",
                history: str = "summary_history", keys: Sequence[str] = SUMMARY_KEYS) -> dict[str, DataFrame]:
    """The summary key is unique in the summary, and so in its merged history."""
    return run(spark, catalog, current, history, keys, unique_keys=True)


def run_mapping(spark: SparkSession, catalog: Catalog, current: str = "delivery_mapping",
                history: str = "mapping_history", keys: Sequence[str] = MAPPING_KEYS,
                keep_history: bool = False) -> dict[str, DataFrame]:
    return run(spark, catalog, current, history, keys, keep_history)


def merge_touched(spark: SparkSession, catalog: Catalog, current: str, history: str, keys: Sequence[str], partition_by: Sequence[str],
                  unique_keys: bool = False) -> dict[str, int]:
    """Merge the current result into its history partition by partition, and store it; returns rows of each step.

    ``partition_by`` are columns of ``keys``, so a row never changes its partition and old rows of partitions without new rows need no look: only
    touched partitions are read, merged and written, the others are referred to where they lie. Rows are counted as they pass.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError(f"{list(partition_by)} must be part of the keys {list(keys)}")
    spec = catalog.spec(history)
    new, seen_new = counted(read_table(spark, catalog, current), "current")
    old = read_table(spark, catalog, history)
    touched = read_table(spark, catalog, current).select(*[F.col(c).alias(f"__{c}") for c in partition_by]).distinct()
    # Partition values may be read with another type than they were written with.
    same = reduce(lambda a, b: a & b, [F.col(c).cast("string").eqNullSafe(F.col(f"__{c}").cast("string")) for c in partition_by])
    old, seen_old = counted(old.join(touched, same, "left_semi"), "history")
    old = old.select(*[F.col(c).cast(new.schema[c].dataType).alias(c) if c in partition_by else F.col(c) for c in old.columns])
    merged, seen = counted(merge_newer(old, new, keys, True, unique_keys), "merged")
    folders = merge_partitions(merged, spec, partition_by)
    return {"current": seen_new.get["n_rows"], "history": seen_old.get["n_rows"], "merged": seen.get["n_rows"], "partitions": len(folders)}


def store(merged: DataFrame, catalog: Catalog, history: str) -> None:
    """Write the merged rows over the history table they were read from."""
    safe_replace(merged, catalog.spec(history))
