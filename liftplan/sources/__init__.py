from liftplan.sources.catalog import Catalog, TableSpec, curated_scan, keyed_scan, patch_rows, read_table, with_months
from liftplan.sources.sinks import append, counted, drop_versions, merge_partitions, publish, replace, safe_replace, write_outputs

__all__ = [
    "Catalog", "TableSpec", "append", "counted", "curated_scan", "drop_versions", "keyed_scan", "merge_partitions", "patch_rows", "publish",
    "read_table", "replace", "safe_replace", "with_months", "write_outputs",
]
