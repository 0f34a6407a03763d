"""Copies between zones, sheet loads, and the collated audit tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from liftplan.operators.columns import rename_all
from liftplan.operators.joins import lookup
from liftplan.sources import Catalog, TableSpec, read_table, replace


def raw_to_curated(spark: SparkSession, catalog: Catalog, table: str, target: TableSpec) -> DataFrame:
    """Copy one raw table to the next zone and return the copy."""
    replace(read_table(spark, catalog, table), target)
    return read_table(spark, Catalog({table: target}), table)


def mapping_sheet_load(spark: SparkSession, catalog: Catalog, sheet: str, target: TableSpec,
                       rename: Mapping[str, str] | None = None) -> DataFrame:
    """Load a CSV sheet into a table, replacing it, and return the table."""
    rows = read_table(spark, catalog, sheet)
    replace(rename_all(rows, rename) if rename else rows, target)
    return read_table(spark, Catalog({sheet: target}), sheet)


def price_audit_collate(backbone: DataFrame, prices: DataFrame, deals: DataFrame,
                        backbone_key: str, price_key: str, deal_key: str) -> DataFrame:
    """Deals with prices that have a backbone row: inner, then left, then distinct.

    The three frames share no column names but the reference number may.
    """
    base = {c: c for c in backbone.columns if c != backbone_key}
    priced = lookup(prices, backbone, on={price_key: backbone_key}, take=base, how="inner")
    rest = {c: c for c in deals.columns if c != deal_key}
    return lookup(priced, deals, on={price_key: deal_key}, take=rest, details=True).distinct()
