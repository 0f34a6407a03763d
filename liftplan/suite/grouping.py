"""Queries for aggregates, windows, sets, reshaping and reuse."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftplan.functions.dates import date_period
from liftplan.functions.numbers import exact, safe_div
from liftplan.operators import aggregate, dedup, reshape
from liftplan.session import reused, stage
from liftplan.suite.joins import _VERSIONS, _versions
from liftplan.suite.registry import query

# ---- aggregates ----


@query("agg_sum_group", """
SELECT l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m') AS period, sum(l_quantity) AS qty,
       sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS price
FROM lineitem GROUP BY 1, 2, 3""")
def agg_sum_group(t):
    rows = t.lineitem.select("l_partkey", "l_suppkey", date_period("l_shipdate").alias("period"),
                             F.col("l_quantity").alias("qty"), exact("l_extendedprice").alias("price"))
    return aggregate.sum_by(rows, ["l_partkey", "l_suppkey", "period"], ["qty", "price"])


@query("agg_avg_sum_wide", """
SELECT o_custkey, o_orderstatus, o_orderpriority, l_returnflag, l_linestatus, strftime(o_orderdate, '%Y-%m') AS period,
       avg(l_quantity) AS avg_target, avg(l_linenumber::DOUBLE) AS avg_plan, sum(l_quantity) AS sum_kg,
       sum(l_quantity * 2) AS sum_l15, sum(l_linenumber)::BIGINT AS sum_to, sum(l_suppkey)::BIGINT AS sum_cbm
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3, 4, 5, 6""")
def agg_avg_sum_wide(t):
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).withColumns(
        {"period": date_period("o_orderdate"), "l15": F.col("l_quantity") * 2,
         "line": F.col("l_linenumber").cast("double")})
    return aggregate.summarise(
        rows, ["o_custkey", "o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus", "period"],
        avg={"avg_target": "l_quantity", "avg_plan": "line"},
        sum={"sum_kg": "l_quantity", "sum_l15": "l15", "sum_to": "l_linenumber", "sum_cbm": "l_suppkey"})


@query("agg_avg_count", """
SELECT l_partkey, l_linestatus, avg(l_quantity) AS avg_qty, count(nullif(l_returnflag, 'N')) AS n,
       avg(l_quantity) / nullif(count(nullif(l_returnflag, 'N')), 0) AS per_contract
FROM lineitem GROUP BY 1, 2""")
def agg_avg_count(t):
    rows = t.lineitem.withColumn("contract", F.nullif("l_returnflag", F.lit("N")))
    out = aggregate.summarise(rows, ["l_partkey", "l_linestatus"], avg={"avg_qty": "l_quantity"}, count={"n": "contract"})
    return out.withColumn("per_contract", safe_div("avg_qty", "n"))


@query("agg_collect_concat", """
SELECT l_orderkey, coalesce(string_agg(nullif(l_returnflag, 'N'), ', ' ORDER BY l_returnflag), '') AS flags
FROM lineitem GROUP BY l_orderkey""")
def agg_collect_concat(t):
    rows = t.lineitem.select("l_orderkey", F.nullif("l_returnflag", F.lit("N")).alias("flags"))
    return aggregate.concat_text(rows, ["l_orderkey"], "flags")


@query("agg_concat_pieces", """
SELECT l_suppkey, string_agg(l_returnflag, ', ' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY l_suppkey""")
def agg_concat_pieces(t):
    """The texts of all suppliers in pieces of 40 characters, and the pieces put together again."""
    pieces = aggregate.concat_pieces(t.lineitem.select("l_suppkey", F.col("l_returnflag").alias("flags")), ["l_suppkey"], "flags", piece_chars=40)
    whole = F.transform(F.array_sort(F.collect_list(F.struct("piece", "flags"))), lambda p: p["flags"])
    return pieces.groupBy("l_suppkey").agg(F.array_join(whole, ", ").alias("flags"))


@query("agg_collect_index", """
SELECT user_id, max(CASE WHEN rn = 1 THEN event_type END) AS first_type, max(CASE WHEN rn = 2 THEN event_type END) AS second_type,
       max(CASE WHEN rn = 2 THEN value END) AS second_value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) GROUP BY user_id""")
def agg_collect_index(t):
    return aggregate.nth_values(t.events, ["user_id"], ["ts", "event_id"], {
        "first_type": ("event_type", 0), "second_type": ("event_type", 1), "second_value": ("value", 1)})


@query("agg_first_last", """
SELECT user_id, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value
FROM events GROUP BY user_id""")
def agg_first_last(t):
    return aggregate.first_last(t.events, ["user_id"], "value", ["ts", "event_id"], "first_value", "last_value")


@query("agg_group_all_columns", """
SELECT c_nationkey::BIGINT AS c_nationkey, c_mktsegment, n, sum(n)::BIGINT AS sum_n
FROM (SELECT c_nationkey, c_mktsegment, c_nationkey * 2 AS n FROM customer) GROUP BY 1, 2, 3""")
def agg_group_all_columns(t):
    rows = t.customer.select("c_nationkey", "c_mktsegment", (F.col("c_nationkey") * 2).alias("n"))
    return aggregate.sum_over_duplicates(rows, {"sum_n": "n"})


@query("agg_row_count", f"""
WITH {_VERSIONS}
SELECT 'current' AS frame, count(*) AS n_rows FROM new UNION ALL SELECT 'history', count(*) FROM old
UNION ALL SELECT 'merged', count(*) FROM old FULL JOIN new USING (o_orderkey)""")
def agg_row_count(t):
    from liftplan.operators.joins import merge_newer
    old, new = _versions(t)
    return aggregate.reconcile(current=new, history=old, merged=merge_newer(old, new, ["o_orderkey"], unique_keys=True))


# ---- windows ----


def _top1_sql(table, keys, order, columns, where="", rank="rn"):
    return (f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS {rank} "
            f"FROM {table}) WHERE {rank} = 1 {where}")


@query("win_latest_version", _top1_sql("events", "user_id", "ts DESC, event_id", "user_id, event_id, event_type, value"))
def win_latest_version(t):
    rows = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    return dedup.top1_per_key(rows, ["user_id"], [F.desc("ts")], ["event_id"]).drop("ts")


@query("win_latest_load_id", _top1_sql("events", "user_id, event_type", "ts DESC, event_id", "user_id, event_type, event_id, value"))
def win_latest_load_id(t):
    rows = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    return dedup.top1_per_key(rows, ["user_id", "event_type"], [F.desc("ts")], ["event_id"]).drop("ts")


@query("win_top1_plan", """
SELECT l_partkey, period, l_suppkey, plan FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, period ORDER BY plan DESC, l_suppkey) AS rn FROM (
    SELECT l_partkey, strftime(l_shipdate, '%Y-%m') AS period, l_suppkey, sum(l_quantity) AS plan FROM lineitem GROUP BY 1, 2, 3))
WHERE rn = 1""")
def win_top1_plan(t):
    rows = t.lineitem.select("l_partkey", date_period("l_shipdate").alias("period"), "l_suppkey", F.col("l_quantity").alias("plan"))
    return dedup.top1_per_key(aggregate.sum_by(rows, ["l_partkey", "period", "l_suppkey"], ["plan"]),
                              ["l_partkey", "period"], [F.desc("plan")], ["l_suppkey"])


@query("win_top1_lifting", _top1_sql(
    "lineitem", "l_orderkey, l_partkey", "l_quantity DESC, l_linenumber, l_suppkey, l_extendedprice, l_shipdate",
    "l_orderkey, l_partkey, l_quantity, l_linenumber::BIGINT AS l_linenumber, l_suppkey, l_extendedprice"))
def win_top1_lifting(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate")
    return dedup.top1_per_key(rows, ["l_orderkey", "l_partkey"], [F.desc("l_quantity")],
                              ["l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate"]).drop("l_shipdate")


@query("win_first_group_asc", _top1_sql(
    "customer", "c_nationkey, c_mktsegment", "c_name, c_custkey", "c_nationkey::BIGINT AS c_nationkey, c_mktsegment, c_name"))
def win_first_group_asc(t):
    rows = t.customer.select("c_nationkey", "c_mktsegment", "c_name", "c_custkey")
    return dedup.top1_per_key(rows, ["c_nationkey", "c_mktsegment"], [F.asc("c_name")], ["c_custkey"]).drop("c_custkey")


_LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


@query("win_dedup_desc", _top1_sql(
    "lineitem", "l_orderkey, l_linenumber",
    "l_returnflag DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate",
    "l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_returnflag, l_partkey, l_suppkey, l_quantity"))
def win_dedup_desc(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", *_LINE_ORDER)
    return dedup.top1_per_key(rows, ["l_orderkey", "l_linenumber"], [F.desc("l_returnflag")], _LINE_ORDER).drop(
        "l_extendedprice", "l_shipdate")


@query("win_dedup_nulls_last", _top1_sql(
    "(SELECT *, nullif(event_type, 'click') AS kind FROM events)", "user_id, CAST(ts AS DATE)",
    "kind ASC NULLS LAST, event_id", "user_id, kind, event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day"))
def win_dedup_nulls_last(t):
    rows = t.events.select("user_id", F.nullif("event_type", F.lit("click")).alias("kind"), "event_id",
                           F.col("ts").cast("date").alias("day"))
    return dedup.top1_per_key(rows, ["user_id", "day"], [F.asc_nulls_last("kind")], ["event_id"])


# ---- sort, sets ----


@query("srt_order_by", """
SELECT o_orderkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders
ORDER BY o_orderdate DESC, o_orderkey""")
def srt_order_by(t):
    """Range-partitioned sort of the whole table."""
    return t.orders.select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate")).orderBy(
        F.desc("o_orderdate"), "o_orderkey")


@query("set_union_all", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'O'""")
def set_union_all(t):
    a = t.orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey", "o_orderpriority")
    b = t.orders.where("o_orderstatus <> 'O'").select("o_orderpriority", "o_orderkey", "o_custkey")
    return a.unionByName(b)


@query("set_except_all", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem
EXCEPT ALL SELECT l_orderkey, l_linenumber::BIGINT FROM lineitem WHERE l_returnflag = 'R'""")
def set_except_all(t):
    """True bag difference; row removal in the jobs uses remove_where instead."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber")
    return rows.exceptAll(t.lineitem.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber"))


@query("set_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def set_distinct(t):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query("set_distinct_subset", _top1_sql(
    "lineitem", "l_orderkey, l_linenumber",
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate",
    "l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate"))
def set_distinct_subset(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", *_LINE_ORDER)
    return dedup.distinct_subset(rows, ["l_orderkey", "l_linenumber"], _LINE_ORDER).withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date"))


# ---- reshape ----

_M = {f"m{i:02d}": f"1998-{i:02d}" for i in range(1, 13)}


@query("rsh_unpivot_months", f"""
WITH wide AS (SELECT l_suppkey, l_returnflag, {", ".join(
    f"sum(CASE WHEN strftime(l_shipdate, '%Y-%m') = '{p}' THEN l_quantity END) AS {m}" for m, p in _M.items())}
    FROM lineitem GROUP BY 1, 2)
{" UNION ALL ".join(f"SELECT l_suppkey, l_returnflag, '{p}' AS period, {m} AS volume FROM wide" for m, p in _M.items())}""")
def rsh_unpivot_months(t):
    period = date_period("l_shipdate")
    wide = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(
        *[F.sum(F.when(period == p, F.col("l_quantity"))).alias(m) for m, p in _M.items()])
    return reshape.unpivot_periods(wide, ["l_suppkey", "l_returnflag"], _M, "period", "volume")


@query("rsh_pivot_strict", """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, min(CASE WHEN event_type = 'click' THEN value END) AS click,
       min(CASE WHEN event_type = 'error' THEN value END) AS error
FROM events WHERE event_type IN ('click', 'error') GROUP BY user_id, CAST(ts AS DATE)
HAVING count(CASE WHEN event_type = 'click' THEN 1 END) = 1 AND count(CASE WHEN event_type = 'error' THEN 1 END) >= 1""")
def rsh_pivot_strict(t):
    rows = t.events.withColumn("day", F.col("ts").cast("date"))
    return reshape.pivot_units(rows, ["user_id", "day"], "event_type", "value", ["click", "error"])


@query("rsh_pivot_loose", """
SELECT l_orderkey, coalesce(a, r) AS a, coalesce(r, a) AS r FROM (
  SELECT l_orderkey, min(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS a,
         min(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS r
  FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY l_orderkey)""")
def rsh_pivot_loose(t):
    """A key with one unit shows its value for both."""
    return reshape.pivot_units(t.lineitem, ["l_orderkey"], "l_returnflag", "l_quantity", ["A", "R"], ["a", "r"],
                               strict=False, repeat_single=True)


# ---- reuse ----


@query("rt_cache_reuse", """
WITH shared AS (SELECT o_custkey, l_partkey, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
SELECT 'customer' AS side, o_custkey AS id, sum(l_quantity) AS qty FROM shared GROUP BY o_custkey
UNION ALL SELECT 'part', l_partkey, sum(l_quantity) FROM shared GROUP BY l_partkey""")
def rt_cache_reuse(t):
    """One kept frame feeds two written aggregates and is released after them."""
    shared = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "l_partkey", "l_quantity")
    with reused(shared) as kept:
        by_customer = stage(aggregate.sum_by(kept, ["o_custkey"], {"qty": "l_quantity"}), "reuse-customer")
        by_part = stage(aggregate.sum_by(kept, ["l_partkey"], {"qty": "l_quantity"}), "reuse-part")
    return by_customer.select(F.lit("customer").alias("side"), F.col("o_custkey").alias("id"), "qty").unionByName(
        by_part.select(F.lit("part").alias("side"), F.col("l_partkey").alias("id"), "qty"))
