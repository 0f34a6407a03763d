"""Queries for predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftplan.functions.dates import text_yyyymmdd
from liftplan.operators.filters import (
    covers, in_list, in_period, non_blank, non_empty, not_in, remove_where, text_date_between, year_is,
)
from liftplan.operators.joins import lookup
from liftplan.session import scratch_path
from liftplan.sources import Catalog, TableSpec, curated_scan, replace
from liftplan.suite.registry import AS_OF, query


@query("flt_in_list", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def flt_in_list(t):
    return t.orders.where(in_list("o_orderpriority", ["1-URGENT", "2-HIGH"])).select("o_orderkey", "o_orderpriority")


@query("flt_not_in", """
SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders
WHERE nullif(o_orderpriority, '5-LOW') NOT IN ('1-URGENT', '2-HIGH')""")
def flt_not_in(t):
    """Rows whose value is null are not kept."""
    rows = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    return rows.where(not_in("priority", ["1-URGENT", "2-HIGH"]))


@query("flt_eq_neq", "SELECT p_partkey, p_type, p_brand FROM part WHERE p_type = 'PROMO' AND p_brand <> 'Brand#3'")
def flt_eq_neq(t):
    return t.part.where((F.col("p_type") == "PROMO") & (F.col("p_brand") != "Brand#3")).select(
        "p_partkey", "p_type", "p_brand")


@query("flt_null_check", """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def flt_null_check(t):
    """Orders whose left-joined item is null."""
    items = t.lineitem.select("l_orderkey").distinct().withColumn("item_order", F.col("l_orderkey"))
    joined = lookup(t.orders.select("o_orderkey", "o_custkey"), items, on={"o_orderkey": "l_orderkey"},
                    take={"item_order": "item_order"})
    return joined.where(F.col("item_order").isNull()).drop("item_order")


_TEXT = "CASE WHEN p_size > 40 THEN NULL WHEN p_size > 30 THEN '' WHEN p_size > 20 THEN '  ' ELSE p_name END"


def _texts(t):
    return t.part.select("p_partkey", F.when(F.col("p_size") > 40, F.lit(None).cast("string"))
                         .when(F.col("p_size") > 30, "").when(F.col("p_size") > 20, "  ")
                         .otherwise(F.col("p_name")).alias("label"))


@query("flt_nonempty_text", f"SELECT p_partkey, label FROM (SELECT p_partkey, {_TEXT} AS label FROM part) WHERE label <> ''")
def flt_nonempty_text(t):
    return _texts(t).where(non_empty("label"))


@query("flt_blank_trimmed", f"SELECT p_partkey, label FROM (SELECT p_partkey, {_TEXT} AS label FROM part) WHERE trim(label) <> ''")
def flt_blank_trimmed(t):
    return _texts(t).where(non_blank("label"))


@query("flt_text_date_range", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, strftime(l_shipdate, '%Y%m%d') AS shipped FROM lineitem
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-09-01' AND DATE '1998-06-30'""")
def flt_text_date_range(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", text_yyyymmdd("l_shipdate").alias("shipped"))
    return rows.where(text_date_between("shipped", "1997-09-01", "1998-06-30"))


@query("flt_month_folders", """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m%d') AS shipped FROM lineitem
WHERE l_shipdate >= DATE '1997-09-15' AND l_shipdate < DATE '1998-02-11'""")
def flt_month_folders(t):
    """Text dates of a table stored by month: only the folders of six months are read."""
    spec = TableSpec("parquet", scratch_path(t.spark, "by-month"), months={"shipped": "ship_month"})
    replace(t.lineitem.select("l_orderkey", "l_linenumber", text_yyyymmdd("l_shipdate").alias("shipped")), spec)
    day = lambda d: F.lit(d).cast("date")
    return curated_scan(t.spark, Catalog({"lines": spec}), "lines", distinct=False, text_dates={"shipped": (day("1997-09-15"), day("1998-02-10"))})


@query("flt_rolling_window", f"""
SELECT o_orderkey, 'year_end' AS rule FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{AS_OF}' - 100 AND DATE '1998-12-31'
UNION ALL
SELECT o_orderkey, 'days_230' FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{AS_OF}' - 100 AND DATE '{AS_OF}' + 230
UNION ALL
SELECT o_orderkey, 'month_end' FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{AS_OF}' - 100 AND DATE '1998-06-30'""")
def flt_rolling_window(t):
    """All three upper ends from one scan."""
    day = F.col("o_orderdate").cast("date")
    ends = {"year_end": "year_end", "days_230": 230, "month_end": "month_end"}
    hits = F.array_compact(F.array(*[F.when(in_period(day, AS_OF, 100, end), F.lit(rule))
                                     for rule, end in ends.items()]))
    return t.orders.select("o_orderkey", F.explode(hits).alias("rule"))


@query("flt_year_equals", "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) = 1997")
def flt_year_equals(t):
    return t.orders.where(year_is(1997, "o_orderdate")).select("o_orderkey", "o_custkey")


@query("flt_like", """
SELECT p_partkey, p_name, p_type FROM part
WHERE p_type LIKE 'S%' AND p_type <> 'SMALL' OR upper(p_name) LIKE '%RING%'""")
def flt_like(t):
    hit = (F.col("p_type").startswith("S") & (F.col("p_type") != "SMALL")) | F.upper("p_name").contains("RING")
    return t.part.where(hit).select("p_partkey", "p_name", "p_type")


@query("flt_between_columns", f"""
SELECT o_orderkey FROM orders
WHERE DATE '{AS_OF}' BETWEEN CAST(o_orderdate AS DATE) - 30 AND CAST(o_orderdate AS DATE) + 60""")
def flt_between_columns(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.where(covers(F.date_sub(day, 30), F.date_add(day, 60), AS_OF)).select("o_orderkey")


@query("flt_numeric_compare", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity FROM lineitem
WHERE l_quantity < 5 OR (l_quantity <= 30 AND l_quantity > 28)""")
def flt_numeric_compare(t):
    q = F.col("l_quantity")
    return t.lineitem.where((q < 5) | ((q <= 30) & (q > 28))).select("l_orderkey", "l_linenumber", "l_quantity")


@query("flt_compound", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, nullif(l_returnflag, 'N') AS flag, l_quantity
FROM lineitem
WHERE NOT coalesce(nullif(l_returnflag, 'N') = 'R' AND (l_quantity > 25 OR l_linestatus = 'F'), FALSE)""")
def flt_compound(t):
    """Null-safe removal: rows whose test is null stay."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")).alias("flag"),
                             "l_quantity", "l_linestatus")
    hit = (F.col("flag") == "R") & ((F.col("l_quantity") > 25) | (F.col("l_linestatus") == "F"))
    return remove_where(rows, hit).drop("l_linestatus")
