"""Queries for sources, sinks and projections."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftplan.functions.numbers import exact
from liftplan.operators.columns import (
    common_columns, drop_all, rename_all, sorted_columns, star_plus,
)
from liftplan.session import scratch_path
from liftplan.sources import Catalog, TableSpec, append, curated_scan, patch_rows, publish, read_table, replace
from liftplan.suite.registry import query

ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
       o_orderpriority
FROM orders"""


def _plain_orders(t):
    return t.orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("src_parquet", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def src_parquet(t):
    return read_table(t.spark, t.catalog, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("src_delta", ORDERS_SQL)
def src_delta(t):
    """Written and read in the lake format of the session (see sources.lake)."""
    spec = TableSpec("parquet", scratch_path(t.spark, "src-lake"))
    replace(_plain_orders(t), spec)
    return read_table(t.spark, Catalog({"orders": spec}), "orders")


PART_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType()),
])


@query("src_csv", "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def src_csv(t):
    spec = TableSpec("csv", scratch_path(t.spark, "src-csv"), PART_SCHEMA)
    replace(t.part, spec)
    return read_table(t.spark, Catalog({"part": spec}), "part")


@query("src_literal_rows", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
UNION ALL SELECT CAST(-1 AS BIGINT), 'Patched customer', NULL""")
def src_literal_rows(t):
    return patch_rows(t.customer.select("c_custkey", "c_name", "c_mktsegment"),
                      [{"c_name": "Patched customer", "c_custkey": -1}])


@query("src_curated_scan", """
SELECT DISTINCT l_orderkey AS order_no, l_partkey AS material, l_suppkey AS plant, l_returnflag
FROM lineitem WHERE l_returnflag IN ('R', 'A')""")
def src_curated_scan(t):
    return curated_scan(t.spark, t.catalog, "lineitem", where=F.col("l_returnflag").isin("R", "A"),
                        columns=["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"],
                        rename={"l_orderkey": "order_no", "l_partkey": "material", "l_suppkey": "plant"})


@query("src_read_timestamp", """
SELECT DISTINCT o_orderkey, o_orderstatus, '1998-06-15 08:30:00' AS read_timestamp FROM orders""")
def src_read_timestamp(t):
    return curated_scan(t.spark, t.catalog, "orders", columns=["o_orderkey", "o_orderstatus"],
                        read_at="1998-06-15 08:30:00")


@query("snk_delta_overwrite", ORDERS_SQL)
def snk_delta_overwrite(t):
    """A table of other rows and columns is replaced whole."""
    spec = TableSpec("parquet", scratch_path(t.spark, "snk-lake"))
    replace(t.customer, spec)
    replace(_plain_orders(t), spec)
    return read_table(t.spark, Catalog({"orders": spec}), "orders")


@query("snk_overwrite_coalesced", ORDERS_SQL)
def snk_overwrite_coalesced(t):
    spec = TableSpec("parquet", scratch_path(t.spark, "snk-files"))
    replace(_plain_orders(t), spec, files=3)
    return read_table(t.spark, Catalog({"orders": spec}), "orders")


@query("snk_table_overwrite", "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey FROM customer")
def snk_table_overwrite(t):
    """The replace() used for database targets, on a file target."""
    spec = TableSpec("parquet", scratch_path(t.spark, "snk-replace"))
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey")
    append(rows, spec)
    replace(rows, spec)
    return read_table(t.spark, Catalog({"customer": spec}), "customer")


@query("snk_table_append", """
SELECT c_nationkey::BIGINT AS c_nationkey, 2 * count(*) AS n_rows FROM customer GROUP BY c_nationkey""")
def snk_table_append(t):
    """The append() used for database targets, on a file target: twice the rows."""
    spec = TableSpec("parquet", scratch_path(t.spark, "snk-append"))
    rows = t.customer.select("c_custkey", "c_nationkey")
    append(rows, spec)
    append(rows, spec)
    stored = read_table(t.spark, Catalog({"customer": spec}), "customer")
    return stored.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_rows"))


@query("snk_temp_view", """
SELECT c_mktsegment, count(*) AS n, min(c_custkey) AS first_key FROM customer GROUP BY c_mktsegment""")
def snk_temp_view(t):
    publish(t.customer, "liftplan_customer")
    return t.spark.sql("SELECT c_mktsegment, count(*) AS n, min(c_custkey) AS first_key "
                       "FROM liftplan_customer GROUP BY c_mktsegment")


@query("prj_select", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def prj_select(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")


@query("prj_select_alias", "SELECT p_partkey AS material_no, p_type AS grade, p_name AS label FROM part")
def prj_select_alias(t):
    blanks = t.part.withColumnsRenamed({"p_partkey": "Material Number", "p_type": "Base Grade", "p_name": "Produkt "})
    return blanks.select(F.col("Material Number").alias("material_no"), F.col("Base Grade").alias("grade"),
                         F.col("Produkt ").alias("label"))


LINE_NAMES = {
    "l_orderkey": "contract_no", "l_partkey": "material_number", "l_suppkey": "plant_code",
    "l_linenumber": "item_number", "l_quantity": "target_quantity", "l_extendedprice": "target_value",
    "l_discount": "discount", "l_tax": "tax", "l_returnflag": "movement_type", "l_linestatus": "handling_type",
    "l_shipdate": "loading_date",
}


@query("prj_bulk_rename", """
SELECT l_orderkey AS contract_no, l_partkey AS material_number, l_suppkey AS plant_code,
       CAST(l_linenumber AS BIGINT) AS item_number, l_quantity AS target_quantity,
       l_extendedprice AS target_value, l_discount AS discount, l_tax AS tax, l_returnflag AS movement_type,
       l_linestatus AS handling_type, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS loading_date
FROM lineitem""")
def prj_bulk_rename(t):
    return rename_all(t.lineitem, LINE_NAMES).withColumn("loading_date", F.col("loading_date").cast("date"))


@query("prj_rename_one", "SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total FROM orders GROUP BY o_custkey")
def prj_rename_one(t):
    """An aggregate's generated name is replaced."""
    priced = t.orders.select("o_custkey", exact("o_totalprice").alias("price"))
    return priced.groupBy("o_custkey").sum("price").withColumnRenamed("sum(price)", "total")


@query("prj_derive", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice * (1 - l_discount) AS net,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross
FROM lineitem""")
def prj_derive(t):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax").withColumns(
        {"net": net, "gross": net * (1 + F.col("l_tax"))}).drop("l_extendedprice", "l_discount", "l_tax")


@query("prj_drop", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def prj_drop(t):
    return drop_all(t.lineitem, ["l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"])


@query("prj_star_plus", """
SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment,
       c_acctbal / 2 AS half, upper(c_mktsegment) AS segment
FROM customer""")
def prj_star_plus(t):
    return star_plus(t.customer, half=F.col("c_acctbal") / 2, segment=F.upper("c_mktsegment"))


@query("prj_column_sort", "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey::BIGINT AS c_nationkey FROM customer")
def prj_column_sort(t):
    return sorted_columns(t.customer.select("c_name", "c_mktsegment", "c_custkey", "c_nationkey", "c_acctbal"))


@query("prj_common_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def prj_common_columns(t):
    reduced = t.orders.select(F.col("o_totalprice").alias("O_TotalPrice"), "o_custkey", "o_orderkey")
    return t.orders.select("o_orderkey", *common_columns(t.orders, reduced, ["O_ORDERKEY"]))
