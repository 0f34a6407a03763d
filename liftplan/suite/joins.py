"""Queries for join shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftplan.functions.dates import date_period
from liftplan.functions.keys import pad_code, strip_zeros
from liftplan.functions.numbers import exact
from liftplan.operators.aggregate import sum_by
from liftplan.operators.joins import full_join_fill, lookup, merge_newer
from liftplan.operators.keyed import Keyed, key_set
from liftplan.session import stage_by_key
from liftplan.sources import publish
from liftplan.suite.registry import query


@query("jn_left_single", """
SELECT o_orderkey, o_custkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def jn_left_single(t):
    return lookup(t.orders.select("o_orderkey", "o_custkey"), t.lineitem, on={"o_orderkey": "l_orderkey"},
                  take={c: c for c in ("l_linenumber", "l_partkey", "l_quantity")}, details=True)


@query("jn_left_multi", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, pair_qty
FROM lineitem LEFT JOIN (SELECT l_partkey AS p, l_suppkey AS s, sum(l_quantity) AS pair_qty FROM lineitem
                         WHERE l_returnflag = 'R' GROUP BY 1, 2) ON p = l_partkey AND s = l_suppkey""")
def jn_left_multi(t):
    pairs = sum_by(t.lineitem.where("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"], {"pair_qty": "l_quantity"})
    return lookup(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), pairs,
                  on={"l_partkey": "l_partkey", "l_suppkey": "l_suppkey"}, take={"pair_qty": "pair_qty"})


@query("jn_inner_single", """
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_name <> 'NATION_3'""")
def jn_inner_single(t):
    nations = t.nation.where(F.col("n_name") != "NATION_3")
    return lookup(t.customer.select("c_custkey", "c_name", "c_nationkey"), nations, on={"c_nationkey": "n_nationkey"},
                  take={"n_name": "n_name"}, how="inner").drop("c_nationkey")


@query("jn_inner_multi", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, n_lines
FROM lineitem JOIN (SELECT l_orderkey AS o, l_linenumber AS n, count(*) AS n_lines FROM lineitem GROUP BY 1, 2
                    HAVING count(*) > 1) ON o = l_orderkey AND n = l_linenumber""")
def jn_inner_multi(t):
    repeated = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_lines")).where("n_lines > 1")
    return lookup(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), repeated,
                  on={"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"}, take={"n_lines": "n_lines"}, how="inner")


def plan_and_actual(t):
    """Plan = open items, actual = finished items, both by part and month."""
    rows = t.lineitem.select("l_partkey", "l_linestatus", "l_quantity", date_period("l_shipdate").alias("period"))
    plan = sum_by(rows.where("l_linestatus = 'O'").withColumnsRenamed({"l_partkey": "plan_part", "period": "plan_period"}),
                  ["plan_part", "plan_period"], {"planned": "l_quantity"})
    actual = sum_by(rows.where("l_linestatus = 'F'").withColumnsRenamed({"l_partkey": "part", "period": "lift_period"}),
                    ["part", "lift_period"], {"lifted": "l_quantity"})
    return plan, actual


_PLAN_ACTUAL = """
plan AS (SELECT l_partkey AS plan_part, strftime(l_shipdate, '%Y-%m') AS plan_period, sum(l_quantity) AS planned
         FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2),
actual AS (SELECT l_partkey AS part, strftime(l_shipdate, '%Y-%m') AS lift_period, sum(l_quantity) AS lifted
           FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2)"""


@query("jn_full_multi", f"""
WITH {_PLAN_ACTUAL}
SELECT part, lift_period, lifted, plan_part, plan_period, planned
FROM actual FULL JOIN plan ON plan_part = part AND plan_period = lift_period""")
def jn_full_multi(t):
    plan, actual = plan_and_actual(t)
    return full_join_fill(actual, plan, on={"part": "plan_part", "lift_period": "plan_period"},
                          unique_keys=True).select(
        "part", "lift_period", "lifted", "plan_part", "plan_period", "planned")


@query("jn_full_expr_key", f"""
WITH {_PLAN_ACTUAL},
padded AS (SELECT lpad(part::VARCHAR, 24, '0') AS material, lift_period, lifted FROM actual),
sheet AS (SELECT lpad(plan_part::VARCHAR, 15, '0') AS plan_material, plan_period, planned FROM plan)
SELECT coalesce(material, plan_material) AS material_number, coalesce(lift_period, plan_period) AS period, lifted, planned
FROM padded FULL JOIN sheet ON substr(material, 10) = plan_material AND plan_period = lift_period""")
def jn_full_expr_key(t):
    plan, actual = plan_and_actual(t)
    padded = actual.withColumn("material", pad_code("part", 24)).withColumn("cut", F.substring("material", 10, 15))
    sheet = plan.withColumn("plan_material", pad_code("plan_part", 15))
    return full_join_fill(
        padded.drop("part"), sheet.drop("plan_part"), on={"cut": "plan_material", "lift_period": "plan_period"},
        fill={"material_number": ("material", "plan_material"), "period": ("lift_period", "plan_period")}, unique_keys=True,
    ).select("material_number", "period", "lifted", "planned")


def _versions(t):
    """History = orders up to 1998; current = orders from 1997, some without price."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")
    old = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).withColumn(
        "o_orderpriority", F.lit("old"))
    new = o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") + 1)).withColumn("extra", F.lit(1))
    return old.drop("o_orderdate"), new.drop("o_orderdate")


_VERSIONS = """
old AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'old' AS o_orderpriority FROM orders
        WHERE o_orderdate < TIMESTAMP '1999-01-01'),
new AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice + 1 END AS o_totalprice,
               o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')"""


@query("jn_full_using_merge", f"""
WITH {_VERSIONS}
SELECT o_orderkey, coalesce(new.o_custkey, old.o_custkey) AS o_custkey,
       coalesce(new.o_orderstatus, old.o_orderstatus) AS o_orderstatus,
       coalesce(new.o_totalprice, old.o_totalprice) AS o_totalprice,
       coalesce(new.o_orderpriority, old.o_orderpriority) AS o_orderpriority
FROM old FULL JOIN new USING (o_orderkey)""")
def jn_full_using_merge(t):
    old, new = _versions(t)
    return merge_newer(old, new, ["o_orderkey"], unique_keys=True)


@query("jn_right_using_merge", """
WITH old AS (SELECT l_orderkey, l_partkey, l_suppkey, sum(l_quantity) AS qty, 'old' AS tag, min(l_tax) AS tax FROM lineitem
             WHERE l_returnflag <> 'N' GROUP BY 1, 2, 3),
new AS (SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN min(l_linestatus) = 'O' THEN sum(l_quantity) * 2 END AS qty,
               'new' AS tag FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1, 2, 3)
SELECT l_orderkey, l_partkey, l_suppkey, coalesce(new.qty, old.qty) AS qty, coalesce(new.tag, old.tag) AS tag
FROM old RIGHT JOIN new USING (l_orderkey, l_partkey, l_suppkey)""")
def jn_right_using_merge(t):
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    old = t.lineitem.where("l_returnflag <> 'N'").groupBy(*keys).agg(
        F.sum("l_quantity").alias("qty"), F.lit("old").alias("tag"), F.min("l_tax").alias("tax"))
    new = t.lineitem.where("l_returnflag <> 'A'").groupBy(*keys).agg(
        F.when(F.min("l_linestatus") == "O", F.sum("l_quantity") * 2).alias("qty"), F.lit("new").alias("tag"))
    return merge_newer(old, new, keys, keep_history=False)


@query("jn_trimmed_key", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, p_name FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def jn_trimmed_key(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                              F.trim(F.concat(F.lit(" "), F.col("l_partkey").cast("string"))).alias("material"))
    parts = t.part.select(F.concat(F.col("p_partkey").cast("string"), F.lit("  ")).alias("padded"), "p_name")
    return lookup(lines, parts.withColumn("material", F.trim("padded")), on={"material": "material"},
                  take={"p_name": "p_name"}).drop("material")


@query("jn_stripped_key", """
SELECT o_orderkey, o_custkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def jn_stripped_key(t):
    orders = t.orders.select("o_orderkey", "o_custkey", strip_zeros(pad_code("o_custkey", 16)).alias("code"))
    customers = t.customer.select(strip_zeros(pad_code("c_custkey", 12)).alias("code"), "c_name")
    return lookup(orders, customers, on={"code": "code"}, take={"c_name": "c_name"}).drop("code")


@query("jn_role_playing", """
SELECT o_orderkey, l_suppkey, c.n_name AS customer_nation, s.n_name AS supplier_nation, r.r_name AS supplier_region
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation c ON c.n_nationkey = c_nationkey
LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation s ON s.n_nationkey = s_nationkey
LEFT JOIN region r ON r.r_regionkey = s.n_regionkey""")
def jn_role_playing(t):
    """Nation is joined once as the customer's and once as the supplier's."""
    df = lookup(t.lineitem.select("l_orderkey", "l_suppkey"), t.orders, on={"l_orderkey": "o_orderkey"},
                take={"o_orderkey": "o_orderkey", "o_custkey": "o_custkey"}, how="inner")
    df = lookup(df, t.customer, on={"o_custkey": "c_custkey"}, take={"c_nationkey": "c_nationkey"})
    df = lookup(df, t.supplier, on={"l_suppkey": "s_suppkey"}, take={"s_nationkey": "s_nationkey"})
    df = lookup(df, t.nation, on={"c_nationkey": "n_nationkey"}, take={"customer_nation": "n_name"})
    df = lookup(df, t.nation, on={"s_nationkey": "n_nationkey"}, take={"supplier_nation": "n_name", "region": "n_regionkey"})
    df = lookup(df, t.region, on={"region": "r_regionkey"}, take={"supplier_region": "r_name"})
    return df.select("o_orderkey", "l_suppkey", "customer_nation", "supplier_nation", "supplier_region")


@query("jn_self_chain", """
WITH order_flow AS (SELECT DISTINCT 'C' || o_custkey AS vbelv, 'O' || o_orderkey AS vbeln FROM orders),
line_flow AS (SELECT DISTINCT 'O' || l_orderkey AS vbelv, 'L' || l_orderkey || '-' || l_linenumber AS vbeln FROM lineitem)
SELECT c_custkey, a.vbeln AS order_doc, b.vbeln AS delivery_doc
FROM customer LEFT JOIN order_flow a ON a.vbelv = 'C' || c_custkey LEFT JOIN line_flow b ON b.vbelv = a.vbeln""")
def jn_self_chain(t):
    """Document flow joined to itself: customer to order to line."""
    def doc(prefix, *parts):
        return F.concat(F.lit(prefix), F.concat_ws("-", *[F.col(p).cast("string") for p in parts]))

    flow = t.orders.select(doc("C", "o_custkey").alias("vbelv"), doc("O", "o_orderkey").alias("vbeln")).distinct()
    flow = flow.unionByName(t.lineitem.select(
        doc("O", "l_orderkey").alias("vbelv"), doc("L", "l_orderkey", "l_linenumber").alias("vbeln")).distinct())
    start = t.customer.select("c_custkey", doc("C", "c_custkey").alias("contract"))
    orders = lookup(start, flow, on={"contract": "vbelv"}, take={"order_doc": "vbeln"}, details=True)
    return lookup(orders, flow, on={"order_doc": "vbelv"}, take={"delivery_doc": "vbeln"}, details=True).drop("contract")


@query("jn_lookup_fill", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END, c_mktsegment) AS label
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def jn_lookup_fill(t):
    orders = t.orders.select("o_orderkey", "o_custkey",
                             F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("label"))
    return lookup(orders, t.customer, on={"o_custkey": "c_custkey"}, take={"label": "c_mktsegment"}, fill=True).drop("o_custkey")


_STAR_TABLES = ("orders", "lineitem", "part", "supplier", "customer", "nation", "region")
_STAR = """
SELECT o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, p_name, s_name, c_name, n_name, r_name, l_quantity
FROM {items}
LEFT JOIN {part} ON p_partkey = l_partkey
LEFT JOIN {supplier} ON s_suppkey = l_suppkey
LEFT JOIN {customer} ON c_custkey = o_custkey
LEFT JOIN {nation} ON n_nationkey = c_nationkey
LEFT JOIN {region} ON r_regionkey = n_regionkey"""
# Orders with their items, then orders without any: a hot order can be split in both parts.
_STAR_ITEMS = """(
SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey
UNION ALL
SELECT o_orderkey, o_custkey, NULL, NULL, NULL, NULL FROM {orders}
WHERE NOT EXISTS (SELECT 1 FROM {lineitem} WHERE l_orderkey = o_orderkey)) items"""


@query("jn_star_chain", _STAR.format(items="orders LEFT JOIN lineitem ON l_orderkey = o_orderkey", **{n: n for n in _STAR_TABLES}))
def jn_star_chain(t):
    """One SQL text over published views."""
    names = {n: f"liftplan_star_{n}" for n in _STAR_TABLES}
    for table, view in names.items():
        publish(getattr(t, table), view)
    return t.spark.sql(_STAR.format(items=_STAR_ITEMS.format(**names), **names))


@query("jn_keyed_chain", """
SELECT l_orderkey, l_linenumber, o_orderkey, o_custkey, c_name, n_name
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""")
def jn_keyed_chain(t):
    """Lookups whose dimensions declare their keys: each is the plain left join, whatever the caller asked for."""
    keyed = lambda df, *key: Keyed(df, key_set([key]))
    df = t.lineitem.select("l_orderkey", "l_linenumber")
    df = lookup(df, keyed(t.orders, "o_orderkey"), on={"l_orderkey": "o_orderkey"}, take={"o_orderkey": "o_orderkey", "o_custkey": "o_custkey"}, details=True)
    df = lookup(df, keyed(t.customer, "c_custkey"), on={"o_custkey": "c_custkey"}, take={"c_name": "c_name", "c_nationkey": "c_nationkey"}, details=True)
    return lookup(df, keyed(t.nation, "n_nationkey"), on={"c_nationkey": "n_nationkey"}, take={"n_name": "n_name"}, details=True).drop("c_nationkey")


@query("jn_bucketed_chain", """
SELECT o_orderkey, o_custkey, l_linenumber, CAST(lines AS BIGINT) AS lines, qty
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
     LEFT JOIN (SELECT l_orderkey AS k, count(*) AS lines, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) g ON k = o_orderkey""")
def jn_bucketed_chain(t):
    """Lookups and a grouping on one key over frames staged by it: none of them shuffles again."""
    orders = stage_by_key(t.orders.select("o_orderkey", "o_custkey"), "orders-by-key", ["o_orderkey"])
    lines = stage_by_key(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "lines-by-key", ["l_orderkey"])
    per_order = lines.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    df = lookup(orders, lines, on={"o_orderkey": "l_orderkey"}, take={"l_linenumber": "l_linenumber"})
    return lookup(df, per_order, on={"o_orderkey": "l_orderkey"}, take={"lines": "n", "qty": "qty"})


@query("jn_full_details", """
WITH sold AS (SELECT l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'),
sent AS (SELECT l_partkey AS part, l_linenumber FROM lineitem WHERE l_returnflag = 'A' AND l_partkey % 3 = 0)
SELECT coalesce(l_partkey, part) AS material, l_suppkey, l_quantity, l_linenumber FROM sold FULL JOIN sent ON part = l_partkey""")
def jn_full_details(t):
    """Full join of two detail tables: keys repeat on both sides."""
    sold = t.lineitem.where("l_returnflag = 'R'").select("l_partkey", "l_suppkey", "l_quantity")
    sent = t.lineitem.where("l_returnflag = 'A' AND l_partkey % 3 = 0").select(F.col("l_partkey").alias("part"), "l_linenumber")
    made = full_join_fill(sold, sent, on={"l_partkey": "part"}, fill={"material": ("l_partkey", "part")})
    return made.select("material", "l_suppkey", "l_quantity", "l_linenumber")
