"""Queries for the business rules, on frames with the domain's column names."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftplan.functions import dates
from liftplan.operators.aggregate import summarise
from liftplan.operators.dedup import keep_unmeasured
from liftplan.operators.joins import full_join_fill, lookup
from liftplan.rules import movements, order_types, parties, periods, plan_rules, quantities
from liftplan.suite.joins import _PLAN_ACTUAL, plan_and_actual
from liftplan.suite.registry import AS_OF, query

# Order types spread over items by their flags; the same text serves both sides.
_TYPE = """CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A' THEN 'TTTT' WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'TTFD'
 WHEN l_linestatus = 'O' AND l_linenumber > 5 THEN 'TRRM' WHEN l_linestatus = 'O' AND l_linenumber > 3 THEN NULL WHEN l_linestatus = 'O' THEN 'TOL_TERM'
 WHEN l_returnflag = 'A' THEN 'TSFP' WHEN l_returnflag = 'N' THEN 'TTTS' WHEN l_linenumber > 4 THEN 'TTTM' ELSE 'TTTI' END"""
_LINE = "l_orderkey, l_linenumber::BIGINT AS l_linenumber"
_GRADE = "CASE p_type WHEN 'STANDARD' THEN 'Mogas' WHEN 'SMALL' THEN 'GtL' WHEN 'LARGE' THEN 'AGO' WHEN 'PROMO' THEN 'IGO' WHEN 'ECONOMY' THEN 'LNG' END"


def _lines(t, **columns):
    """Item rows with expressions given as SQL text."""
    return t.lineitem.select("l_orderkey", "l_linenumber", *[F.expr(e).alias(n) for n, e in columns.items()])


def _orders(t, **columns):
    return t.orders.select("o_orderkey", *[F.expr(e).alias(n) for n, e in columns.items()])


# ---- order types ----

_SCHEME = "CASE WHEN l_tax > 0.06 THEN 'TERM' WHEN l_tax > 0.04 THEN 'TERMMAN' WHEN l_tax > 0.02 THEN 'SPOT' WHEN l_tax > 0.01 THEN '' END"


@query("biz_deal_type", """
SELECT o_orderkey, kschl, CASE WHEN kschl IN ('YP03', 'YP04') THEN 'TERM' WHEN kschl IN ('YP23', 'YP24') THEN 'SPOT' ELSE 'TERMMAN' END AS pricing_scheme
FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'YP03' WHEN '2-HIGH' THEN 'YP10' WHEN '3-MEDIUM' THEN 'YP24' WHEN '5-LOW' THEN 'ZZ01' END AS kschl FROM orders)
WHERE kschl IN ('YP03', 'YP04', 'YP09', 'YP10', 'YP23', 'YP24')""")
def biz_deal_type(t):
    return order_types.deal_type(_orders(t, kschl="CASE o_orderpriority WHEN '1-URGENT' THEN 'YP03' WHEN '2-HIGH' THEN 'YP10' "
                                                  "WHEN '3-MEDIUM' THEN 'YP24' WHEN '5-LOW' THEN 'ZZ01' END"))


_RAW_TYPE = "CASE WHEN l_returnflag = 'A' THEN 'TTTT' WHEN l_returnflag = 'N' THEN '' END"
_DOC = "CASE WHEN l_linenumber > 6 THEN NULL WHEN l_linenumber > 3 THEN 'ZCRM' ELSE 'ZCQ' END"


@query("biz_order_type_default", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, auart, pricing_scheme,
       CASE WHEN bsark_e <> '' THEN bsark_e WHEN auart IS NULL THEN bsark_e WHEN auart = 'ZCRM' THEN 'TRRM'
            WHEN pricing_scheme IN ('SPOT', 'TERMMAN') THEN 'TSFP' ELSE 'TTFD' END AS bsark_e
FROM (SELECT *, {_RAW_TYPE} AS bsark_e, {_DOC} AS auart, {_SCHEME} AS pricing_scheme FROM lineitem)""")
def biz_order_type_default(t):
    return order_types.order_type_default(_lines(t, bsark_e=_RAW_TYPE, auart=_DOC, pricing_scheme=_SCHEME))


@query("biz_manual_flag", f"""
SELECT {_LINE}, {_TYPE} AS purchase_order_type, CASE WHEN ({_TYPE}) IS NULL THEN 'Yes' ELSE 'No' END AS pot_manual_update FROM lineitem""")
def biz_manual_flag(t):
    return order_types.manual_flag(_lines(t, purchase_order_type=_TYPE))


_SHIPPING = "CASE o_orderpriority WHEN '1-URGENT' THEN '10' WHEN '2-HIGH' THEN '30' WHEN '3-MEDIUM' THEN '20' WHEN '4-NOT SPECIFIED' THEN '80' ELSE '10' END"


@query("biz_overlift_class", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, shipping_condition_tbu, pricing_scheme, creation_date, valid_to,
       CASE WHEN shipping_condition_tbu = '10' AND pricing_scheme = 'TERMMAN' AND creation_date >= valid_to AND pot = 'TTFD' THEN 'TOL_TERM'
            WHEN shipping_condition_tbu = '10' AND pricing_scheme = 'TERMMAN' AND creation_date >= valid_to AND pot = 'TTTT' THEN 'TOL_TRIGGER'
            ELSE pot END AS purchase_order_type
FROM (SELECT l_orderkey, l_linenumber, {_TYPE} AS pot, {_SCHEME} AS pricing_scheme, {_SHIPPING} AS shipping_condition_tbu,
             strftime(o_orderdate, '%Y%m%d') AS valid_to, strftime(l_shipdate, '%Y%m%d') AS creation_date
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey)""")
def biz_overlift_class(t):
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "l_orderkey", "l_linenumber", F.expr(_TYPE).alias("purchase_order_type"), F.expr(_SCHEME).alias("pricing_scheme"),
        F.expr(_SHIPPING).alias("shipping_condition_tbu"), dates.text_yyyymmdd("o_orderdate").alias("valid_to"),
        dates.text_yyyymmdd("l_shipdate").alias("creation_date"))
    return order_types.overlift_class(rows)


_PRICING = "CASE WHEN l_tax > 0.06 THEN 'Trigger' WHEN l_tax > 0.04 THEN 'Half-Month' WHEN l_tax > 0.02 THEN 'Decade' WHEN l_tax > 0 THEN 'Monthly' END"


@query("biz_late_type_default", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, pricing_period,
       CASE WHEN pot IS NULL AND pricing_period = 'Trigger' THEN 'TTTT' WHEN pot IS NULL AND pricing_period IS NOT NULL THEN 'TTFD' ELSE pot END AS purchase_order_type
FROM (SELECT *, {_TYPE} AS pot, {_PRICING} AS pricing_period FROM lineitem)""")
def biz_late_type_default(t):
    return order_types.late_type_default(_lines(t, purchase_order_type=_TYPE, pricing_period=_PRICING))


@query("biz_spot_label", f"""
SELECT {_LINE}, {_TYPE} AS purchase_order_type,
       CASE WHEN ({_TYPE}) IN ('TSFP', 'TRRM', 'TOL') THEN 'spot' ELSE {_PRICING} END AS pricing_period FROM lineitem""")
def biz_spot_label(t):
    return order_types.spot_label(_lines(t, purchase_order_type=_TYPE, pricing_period=_PRICING))


# ---- plan rules ----


@query("biz_plant_remap", f"""
SELECT {_LINE}, CASE WHEN l_suppkey = 3 THEN 'D361' WHEN l_suppkey = 5 THEN 'D361' ELSE 'P' || l_suppkey END AS supply_point FROM lineitem""")
def biz_plant_remap(t):
    return plan_rules.plant_remap(_lines(t, supply_point="CASE WHEN l_suppkey = 3 THEN 'D333' WHEN l_suppkey = 5 THEN 'D361' "
                                                         "ELSE 'P' || CAST(l_suppkey AS STRING) END"), merges={"D333": "D361"})


_CODE = """CASE o_orderpriority WHEN '1-URGENT' THEN CASE o_orderstatus WHEN 'F' THEN '10' WHEN 'O' THEN '11' ELSE '80' END
 WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'F' THEN '30' WHEN 'O' THEN '31' ELSE '40' END
 WHEN '3-MEDIUM' THEN CASE o_orderstatus WHEN 'F' THEN '20' ELSE '21' END WHEN '4-NOT SPECIFIED' THEN '99' END"""


@query("biz_transport_mode", f"""
SELECT o_orderkey, {_CODE} AS shipping_condition_tbu,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'ITT' WHEN o_orderpriority = '1-URGENT' THEN 'Truck'
            WHEN o_orderpriority = '2-HIGH' THEN 'Barge' WHEN o_orderpriority = '3-MEDIUM' THEN 'Rail' ELSE '' END AS mot FROM orders""")
def biz_transport_mode(t):
    return plan_rules.transport_mode(_orders(t, shipping_condition_tbu=_CODE))


_MODE = "CASE WHEN l_linenumber = 1 THEN 'ITT' WHEN l_linenumber = 2 THEN 'Barge' WHEN l_linenumber = 3 THEN 'Rail' WHEN l_linenumber < 6 THEN 'Truck' END"
_INCO = "CASE l_returnflag WHEN 'A' THEN 'FOB' WHEN 'R' THEN 'FCA' END"


@query("biz_shipping_term", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, mot, incoterm,
       CASE WHEN mot = 'ITT' THEN 'In-Tank' WHEN mot = 'Barge' AND incoterm = 'FOB' THEN 'Vessel Pickup'
            WHEN mot = 'Barge' AND incoterm <> 'FOB' THEN 'Vessel Delivery' WHEN mot = 'Rail' AND incoterm = 'FCA' THEN 'Rail Pickup'
            WHEN mot = 'Rail' AND incoterm <> 'FCA' THEN 'Rail Delivery' WHEN mot = 'Truck' AND incoterm = 'FCA' THEN 'Road Pickup'
            ELSE 'Road Delivery' END AS shipping_condition_term
FROM (SELECT *, {_MODE} AS mot, {_INCO} AS incoterm FROM lineitem)""")
def biz_shipping_term(t):
    return plan_rules.shipping_term(_lines(t, mot=_MODE, incoterm=_INCO))


@query("biz_plan_units", f"""
SELECT {_LINE}, l_quantity AS plan_to, l_discount AS density, l_quantity / nullif(l_discount, 0) AS plan_m3,
       l_quantity * l_discount AS tonnes_of_m3 FROM lineitem""")
def biz_plan_units(t):
    """Both directions; a density of zero gives no volume."""
    rows = plan_rules.plan_units(_lines(t, plan_to="l_quantity", density="l_discount"), "plan_to")
    volume = rows.withColumnsRenamed({"plan_m3": "v", "plan_to": "plan_m3"})
    both = plan_rules.plan_units(volume, "plan_m3")
    return both.withColumnsRenamed({"plan_to": "tonnes_of_m3", "plan_m3": "plan_to"}).withColumnRenamed("v", "plan_m3")


@query("biz_pricing_bucket", f"""
SELECT {_LINE}, CASE WHEN l_returnflag = 'N' THEN NULL ELSE strftime(l_shipdate, '%Y%m%d') END AS valid_from,
       CASE WHEN p = 'Half-Month' AND d = 1 THEN 'H1' WHEN p = 'Half-Month' AND d = 16 THEN 'H2'
            WHEN p = 'Decade' AND d = 1 THEN 'D1' WHEN p = 'Decade' AND d = 11 THEN 'D2' WHEN p = 'Decade' THEN 'D3' ELSE p END AS pricing_period
FROM (SELECT *, {_PRICING} AS p, CASE WHEN l_returnflag = 'N' THEN NULL ELSE day(l_shipdate) END AS d FROM lineitem)""")
def biz_pricing_bucket(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.expr(_PRICING).alias("pricing_period"),
                             F.when(F.col("l_returnflag") != "N", dates.text_yyyymmdd("l_shipdate")).alias("valid_from"))
    return plan_rules.pricing_bucket(rows)


@query("biz_plan_split", f"""
SELECT {_LINE}, {_PRICING} AS pricing_period,
       CASE ({_PRICING}) WHEN 'Half-Month' THEN l_quantity / 2 WHEN 'Decade' THEN l_quantity / 3 ELSE l_quantity END AS plan_m3 FROM lineitem""")
def biz_plan_split(t):
    return plan_rules.plan_split(_lines(t, pricing_period=_PRICING, plan_m3="l_quantity"))


_PLAN_ITEMS = f"""
SELECT l_orderkey AS id, l_linenumber::BIGINT AS line, strftime(l_shipdate, '%Y-%m') AS contract_start_period, l_suppkey AS ship_to_number, l_linestatus AS plant_code,
       l_partkey AS material_number, {_MODE} AS mot, {_PRICING} AS pricing_period, {_TYPE} AS purchase_order_type,
       CASE WHEN l_discount > 0.02 THEN l_orderkey END AS contract_no, l_quantity AS avg_plan_m3, l_quantity * 2 AS avg_plan_to
FROM lineitem"""
_TRIGGER = f"""
WITH items AS ({_PLAN_ITEMS}),
plans AS (SELECT contract_start_period, ship_to_number, plant_code, material_number, mot,
                 avg(avg_plan_m3) / nullif(count(contract_no), 0) AS trigger_contract_num_plan,
                 avg(avg_plan_to) / nullif(count(contract_no), 0) AS trigger_contract_num_plan_to
          FROM items WHERE (pricing_period = 'Trigger' AND purchase_order_type <> 'TTTM')
                        OR (pricing_period <> 'Trigger' AND mot IN ('ITT', 'Barge', 'Rail'))
          GROUP BY 1, 2, 3, 4, 5),
joined AS (SELECT i.*, trigger_contract_num_plan, trigger_contract_num_plan_to FROM items i LEFT JOIN plans p
           ON p.contract_start_period = i.contract_start_period AND p.ship_to_number = i.ship_to_number
           AND p.plant_code = i.plant_code AND p.material_number = i.material_number AND p.mot IS NOT DISTINCT FROM i.mot)
"""


def _plan_items(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), dates.date_period("l_shipdate").alias("contract_start_period"),
        F.col("l_suppkey").alias("ship_to_number"), F.col("l_linestatus").alias("plant_code"), F.col("l_partkey").alias("material_number"),
        F.expr(_MODE).alias("mot"), F.expr(_PRICING).alias("pricing_period"), F.expr(_TYPE).alias("purchase_order_type"),
        F.expr("CASE WHEN l_discount > 0.02 THEN l_orderkey END").alias("contract_no"), F.col("l_quantity").alias("avg_plan_m3"),
        (F.col("l_quantity") * 2).alias("avg_plan_to"))


@query("biz_trigger_plan", _TRIGGER + """
SELECT id, line, contract_start_period, material_number, ship_to_number, mot, pricing_period, trigger_contract_num_plan, trigger_contract_num_plan_to FROM joined""")
def biz_trigger_plan(t):
    return plan_rules.trigger_plan(_plan_items(t)).select(
        "id", "line", "contract_start_period", "material_number", "ship_to_number", "mot", "pricing_period",
        "trigger_contract_num_plan", "trigger_contract_num_plan_to")


@query("biz_trigger_plan_without_mode", _TRIGGER.replace(" AND p.mot IS NOT DISTINCT FROM i.mot", "") + """
SELECT id, line, contract_start_period, material_number, ship_to_number, mot, pricing_period, trigger_contract_num_plan, trigger_contract_num_plan_to FROM joined""")
def biz_trigger_plan_without_mode(t):
    """Joined back on four keys only: a key with two modes multiplies its rows."""
    return plan_rules.trigger_plan(_plan_items(t), match_mode=False).select(
        "id", "line", "contract_start_period", "material_number", "ship_to_number", "mot", "pricing_period",
        "trigger_contract_num_plan", "trigger_contract_num_plan_to")


@query("biz_trigger_override", _TRIGGER + """
SELECT id, line, mot, pricing_period, CASE WHEN pricing_period = 'Trigger' OR mot IN ('ITT', 'Barge', 'Rail') THEN trigger_contract_num_plan ELSE avg_plan_m3 END AS avg_plan_m3,
       CASE WHEN pricing_period = 'Trigger' OR mot IN ('ITT', 'Barge', 'Rail') THEN trigger_contract_num_plan_to ELSE avg_plan_to END AS avg_plan_to FROM joined""")
def biz_trigger_override(t):
    return plan_rules.trigger_override(plan_rules.trigger_plan(_plan_items(t))).select(
        "id", "line", "mot", "pricing_period", "avg_plan_m3", "avg_plan_to")


# ---- liftings and quantities ----

_MEASURED = """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_extendedprice, nullif(l_returnflag, 'A') AS fed_contract,
 CASE WHEN l_discount > 0.03 THEN l_quantity * 1000 END AS lifting_in_kg, CASE WHEN l_discount > 0.06 THEN l_quantity * 1250 END AS lifting_in_l15,
 CASE WHEN l_discount > 0.03 THEN l_quantity END AS lifting_in_to, CASE WHEN l_discount > 0.06 THEN l_quantity * 1.25 END AS lifting_in_cbm,
 l_suppkey AS delivery_number FROM lineitem"""


@query("biz_null_lifting_keep", f"""
WITH rows AS ({_MEASURED}),
one AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, lifting_in_to
          ORDER BY fed_contract DESC NULLS LAST, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM rows),
two AS (SELECT *, row_number() OVER (PARTITION BY delivery_number, lifting_in_to, lifting_in_cbm
          ORDER BY fed_contract ASC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn2 FROM one WHERE rn = 1)
SELECT l_orderkey, l_linenumber, l_partkey, fed_contract, lifting_in_kg, lifting_in_l15, delivery_number FROM two WHERE rn2 = 1
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, fed_contract, lifting_in_kg, lifting_in_l15, delivery_number FROM one
          WHERE rn > 1 AND lifting_in_kg IS NULL AND lifting_in_l15 IS NULL
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, fed_contract, lifting_in_kg, lifting_in_l15, delivery_number FROM two
          WHERE rn2 > 1 AND lifting_in_kg IS NULL AND lifting_in_l15 IS NULL""")
def biz_null_lifting_keep(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.nullif("l_returnflag", F.lit("A")).alias("fed_contract"),
        F.expr("CASE WHEN l_discount > 0.03 THEN l_quantity * 1000 END").alias("lifting_in_kg"),
        F.expr("CASE WHEN l_discount > 0.06 THEN l_quantity * 1250 END").alias("lifting_in_l15"),
        F.expr("CASE WHEN l_discount > 0.03 THEN l_quantity END").alias("lifting_in_to"),
        F.expr("CASE WHEN l_discount > 0.06 THEN l_quantity * 1.25D END").alias("lifting_in_cbm"),
        F.col("l_suppkey").alias("delivery_number"))
    kept = keep_unmeasured(
        rows, ["lifting_in_kg", "lifting_in_l15"], ["l_orderkey", "lifting_in_to"], [F.desc("fed_contract")],
        ["delivery_number", "lifting_in_to", "lifting_in_cbm"], [F.asc_nulls_last("fed_contract")],
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "fed_contract", "lifting_in_kg", "lifting_in_l15", "delivery_number")


_UOM = "CASE l_returnflag WHEN 'A' THEN 'TO' WHEN 'N' THEN 'M15' ELSE CASE WHEN l_linestatus = 'O' THEN 'L15' END END"


@query("biz_target_units", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, avg_target_quantity, uom, grade,
       CASE WHEN uom = 'L15' THEN avg_target_quantity WHEN grade IS NULL THEN NULL WHEN uom = 'TO' THEN avg_target_quantity
            WHEN uom IS NOT NULL THEN avg_target_quantity * d END AS target_qty_to,
       CASE WHEN uom = 'L15' THEN avg_target_quantity / 1000 WHEN grade IS NULL THEN NULL WHEN uom = 'TO' THEN avg_target_quantity / d
            WHEN uom IS NOT NULL THEN avg_target_quantity END AS target_qty_m3
FROM (SELECT l_orderkey, l_linenumber, l_quantity AS avg_target_quantity, {_UOM} AS uom, {_GRADE} AS grade,
             (CASE p_type WHEN 'STANDARD' THEN 0.755 WHEN 'SMALL' THEN 0.779 ELSE 0.845 END)::DOUBLE AS d
      FROM lineitem JOIN part ON p_partkey = l_partkey)""")
def biz_target_units(t):
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("avg_target_quantity"), F.expr(_UOM).alias("uom"), F.expr(_GRADE).alias("grade"))
    return quantities.target_units(rows)


@query("biz_tolerance", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, purchase_order_type, avg_target_quantity,
       CASE WHEN purchase_order_type = 'TRRM' THEN avg_target_quantity * 0 WHEN purchase_order_type <> 'TSFP' THEN target_qty_m3 * 0.05
            WHEN purchase_order_type = 'TSFP' AND avg_target_quantity > 300 THEN 15 WHEN purchase_order_type = 'TSFP' AND avg_target_quantity > 100 THEN 10
            WHEN purchase_order_type = 'TSFP' AND avg_target_quantity <= 100 THEN 5 END AS tolerance_m15
FROM (SELECT *, {_TYPE} AS purchase_order_type, l_quantity * 10 AS avg_target_quantity, l_quantity / 4 AS target_qty_m3 FROM lineitem)""")
def biz_tolerance(t):
    rows = _lines(t, purchase_order_type=_TYPE, avg_target_quantity="l_quantity * 10", target_qty_m3="l_quantity / 4")
    return quantities.tolerance(rows).drop("target_qty_m3")


@query("biz_audit_volume", """
WITH report AS (SELECT l_orderkey AS c, l_partkey AS m, l_suppkey AS p, sum(l_quantity) AS v FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, coalesce(v, l_quantity / 4) AS volume_cbm
FROM lineitem LEFT JOIN report ON c = l_orderkey AND m = l_partkey AND p = l_suppkey""")
def biz_audit_volume(t):
    keys = {"l_orderkey": "contract_no", "l_partkey": "material_number", "l_suppkey": "plant_code"}
    lines = t.lineitem.withColumnsRenamed(keys)
    report = lines.where("l_returnflag = 'R'").groupBy(*keys.values()).agg(F.sum("l_quantity").alias("volume_cbm"))
    rows = lines.select(*keys.values(), "l_linenumber", (F.col("l_quantity") / 4).alias("target_qty_m3"))
    return quantities.audit_volume(rows, report).select(F.col("contract_no").alias("l_orderkey"), "l_linenumber", "volume_cbm")


_RATIO_COLUMNS = {
    "purchase_order_type": _TYPE, "sum_lifting_in_cbm": "CASE WHEN l_discount > 0.02 THEN l_quantity ELSE 0 END",
    "target_qty_m3": "l_quantity - 10", "avg_plan_m3": "CASE WHEN l_tax > 0.01 THEN l_quantity / 4 END",
    "volume_cbm": "CASE WHEN l_tax < 0.07 THEN l_quantity / 8 END",
}
_RATIO_ROWS = f"(SELECT l_orderkey, l_linenumber, l_partkey, {', '.join(f'{e} AS {n}' for n, e in _RATIO_COLUMNS.items())} FROM lineitem)"


def _ratio_rows(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", *[F.expr(e).cast("double" if n != "purchase_order_type" else "string").alias(n)
                                                                         for n, e in _RATIO_COLUMNS.items()])


@query("biz_fulfil_ratio", f"""
SELECT {_LINE}, CASE WHEN purchase_order_type IN ('TSFP', 'TTTT', 'TRRM', 'TOL', 'TTTS') THEN sum_lifting_in_cbm / nullif(target_qty_m3, 0)
                     WHEN purchase_order_type IS NOT NULL THEN sum_lifting_in_cbm / nullif(avg_plan_m3, 0) END AS erfullt_zu FROM {_RATIO_ROWS}""")
def biz_fulfil_ratio(t):
    return quantities.fulfil_ratio(_ratio_rows(t)).select("l_orderkey", "l_linenumber", "erfullt_zu")


_PLANNED = """CASE WHEN purchase_order_type IN ('TRRM', 'TOL_TERM', 'TOL_TRIGGER') THEN target_qty_m3
 WHEN purchase_order_type IN ('TSFP', 'TTTT', 'TTTS', 'TTTM', 'TTTI') THEN volume_cbm WHEN purchase_order_type IS NOT NULL THEN avg_plan_m3 END"""


@query("biz_planned_qty", f"""
SELECT {_LINE}, CASE WHEN coalesce(q, 1) < 3 THEN coalesce(q, 1) / 1000 ELSE q END AS fullcalc_phil FROM (SELECT *, {_PLANNED} AS q FROM {_RATIO_ROWS})""")
def biz_planned_qty(t):
    return quantities.planned_quantity(_ratio_rows(t)).select("l_orderkey", "l_linenumber", "fullcalc_phil")


@query("biz_plan_override_ttt", f"""
SELECT {_LINE}, CASE WHEN ({_TYPE}) LIKE 'TTT%' AND ({_TYPE}) <> 'TTTS' AND l_discount > 0.02 THEN l_quantity / 8 ELSE l_quantity END AS avg_plan_m3 FROM lineitem""")
def biz_plan_override_ttt(t):
    rows = _lines(t, purchase_order_type=_TYPE, contract_no="CASE WHEN l_discount > 0.02 THEN l_orderkey END",
                  trigger_contract_num_plan="l_quantity / 8", avg_plan_m3="l_quantity")
    return quantities.plan_override_ttt(rows).select("l_orderkey", "l_linenumber", "avg_plan_m3")


_DEPOT = "CASE WHEN l_returnflag = 'A' THEN ' back-up ' WHEN l_returnflag = 'N' THEN 'main' END"


@query("biz_backup_prune", f"""
SELECT {_LINE}, {_DEPOT} AS depot_property FROM lineitem
WHERE NOT (l_returnflag = 'A' AND l_discount <= 0.02 AND coalesce(CASE WHEN l_tax > 0.01 THEN l_quantity / 4 END < 5, FALSE))""")
def biz_backup_prune(t):
    rows = _lines(t, depot_property=_DEPOT, sum_lifting_in_cbm="CASE WHEN l_discount > 0.02 THEN l_quantity ELSE 0 END",
                  avg_plan_m3="CASE WHEN l_tax > 0.01 THEN l_quantity / 4 END")
    return quantities.backup_prune(rows).select("l_orderkey", "l_linenumber", "depot_property")


@query("biz_open_quantity", f"""
WITH {_PLAN_ACTUAL}
SELECT coalesce(part, plan_part) AS part_no, coalesce(lift_period, plan_period) AS period, planned - lifted AS open_qty_m3
FROM actual FULL JOIN plan ON plan_part = part AND plan_period = lift_period""")
def biz_open_quantity(t):
    return quantities.open_quantity(_plan_full(t), "planned", "lifted").select("part_no", "period", "open_qty_m3")


def _plan_full(t):
    plan, actual = plan_and_actual(t)
    return full_join_fill(actual, plan, on={"part": "plan_part", "lift_period": "plan_period"}, unique_keys=True,
                          fill={"part_no": ("part", "plan_part"), "period": ("lift_period", "plan_period")})


@query("biz_contract_split", f"""
WITH {_PLAN_ACTUAL},
both_sides AS (SELECT coalesce(part, plan_part) AS part_no, coalesce(lift_period, plan_period) AS period, part, lifted, planned
         FROM actual FULL JOIN plan ON plan_part = part AND plan_period = lift_period)
SELECT 'contract' AS side, part_no, period, lifted, planned FROM both_sides WHERE part IS NOT NULL
UNION ALL SELECT DISTINCT 'plan only', part_no, period, lifted, planned FROM both_sides WHERE part IS NULL""")
def biz_contract_split(t):
    with_contract, without = quantities.contract_split(_plan_full(t).select("part", "part_no", "period", "lifted", "planned"), "part")
    return with_contract.select(F.lit("contract").alias("side"), "part_no", "period", "lifted", "planned").unionByName(
        without.select(F.lit("plan only").alias("side"), "part_no", "period", "lifted", "planned"))


@query("biz_customer_halving", f"""
SELECT {_LINE}, CASE WHEN l_suppkey IN (7, 9) AND l_partkey NOT IN (4, 5) THEN l_quantity / 2 ELSE l_quantity END AS avg_plan_m3,
       CASE WHEN l_suppkey IN (7, 9) AND l_partkey NOT IN (4, 5) THEN l_quantity * 3 / 2 ELSE l_quantity * 3 END AS avg_plan_to,
       CASE WHEN l_suppkey IN (7, 9) AND l_partkey NOT IN (4, 5) THEN (l_quantity + 1) / 2 ELSE l_quantity + 1 END AS fullcalc_phil FROM lineitem""")
def biz_customer_halving(t):
    rows = _lines(t, ship_to_number="l_suppkey", plant_code="l_partkey", avg_plan_m3="l_quantity", avg_plan_to="l_quantity * 3", fullcalc_phil="l_quantity + 1")
    return quantities.customer_halving(rows, [7, 9], [4, 5]).drop("ship_to_number", "plant_code")


_SUMS = "SELECT l_partkey, l_returnflag, sum(l_quantity) / 1000 AS sum_sum_lifting_in_cbm, sum(l_discount * 0) + count(*) / 10 AS sum_fullcalc_phil FROM lineitem GROUP BY 1, 2"


@query("biz_fulfil_percent", f"""
SELECT l_partkey, l_returnflag, CASE WHEN sum_fullcalc_phil > 0.9 THEN sum_sum_lifting_in_cbm / sum_fullcalc_phil * 100 END AS "erfüllung" FROM ({_SUMS})""")
def biz_fulfil_percent(t):
    sums = t.lineitem.groupBy("l_partkey", "l_returnflag").agg(
        (F.sum("l_quantity") / 1000).alias("sum_sum_lifting_in_cbm"), (F.count(F.lit(1)) / 10).alias("sum_fullcalc_phil"))
    return quantities.fulfil_percent(sums).drop("sum_sum_lifting_in_cbm", "sum_fullcalc_phil")


@query("biz_fulfil_vs_plan", f"""
SELECT {_LINE}, CASE WHEN sum_lifting_in_cbm = 0 THEN 0 WHEN avg_plan_m3 < 5 THEN NULL ELSE sum_lifting_in_cbm / nullif(target_qty_m3, 0) END AS fullfillment_vs_plan FROM {_RATIO_ROWS}""")
def biz_fulfil_vs_plan(t):
    rows = _ratio_rows(t).withColumnRenamed("target_qty_m3", "fullcalc_phil")
    return quantities.fulfil_vs_plan(rows).select("l_orderkey", "l_linenumber", "fullfillment_vs_plan")


@query("biz_fulfil_vs_target", f"SELECT {_LINE}, sum_lifting_in_cbm / nullif(target_qty_m3, 0) AS fullfillment_vs_target FROM {_RATIO_ROWS}")
def biz_fulfil_vs_target(t):
    rows = _ratio_rows(t).withColumnRenamed("target_qty_m3", "avg_target_quantity")
    return quantities.fulfil_vs_target(rows).select("l_orderkey", "l_linenumber", "fullfillment_vs_target")


@query("biz_product_label", f"""
SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN 'Benzin' WHEN 'SMALL' THEN p_brand WHEN 'LARGE' THEN 'Diesel' WHEN 'PROMO' THEN 'Heizöl'
                              WHEN 'ECONOMY' THEN 'LNG' ELSE 'Other' END AS produkt FROM part""")
def biz_product_label(t):
    rows = t.part.select("p_partkey", F.expr(_GRADE).alias("grade"), F.col("p_brand").alias("subgrade"))
    return quantities.product_label(rows).select("p_partkey", "produkt")


# ---- validity ----

_VALID = f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {_TYPE} AS purchase_order_type, CAST(o_orderdate AS DATE) AS valid_from, CAST(o_orderdate AS DATE) + 45 AS valid_to
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""


def _valid_rows(t):
    day = F.col("o_orderdate").cast("date")
    return t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "l_orderkey", "l_linenumber", F.expr(_TYPE).alias("purchase_order_type"), day.alias("valid_from"), F.date_add(day, 45).alias("valid_to"),
        dates.date_period(day).alias("contract_start_period"), dates.date_period(F.date_add(day, 45)).alias("contract_end_period"))


@query("biz_pickup_period", f"""
SELECT l_orderkey, l_linenumber, purchase_order_type,
       CASE WHEN purchase_order_type IN ('TTTM', 'TTTS', 'TTTT', 'TTTI') THEN strftime(valid_from, '%Y-%m')
            WHEN month(valid_from) = 6 THEN strftime(valid_from, '%Y-%m') WHEN month(valid_to) = 6 THEN strftime(valid_to, '%Y-%m')
            ELSE strftime(valid_from, '%Y-%m') END AS abholzeitraum FROM ({_VALID})""")
def biz_pickup_period(t):
    return periods.pickup_period(_valid_rows(t), AS_OF).select("l_orderkey", "l_linenumber", "purchase_order_type", "abholzeitraum")


@query("biz_active_flag", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN DATE '{AS_OF}' BETWEEN valid_from AND valid_to THEN 'Active' ELSE 'Inactive' END AS active FROM ({_VALID})""")
def biz_active_flag(t):
    return periods.active_flag(_valid_rows(t), AS_OF).select("l_orderkey", "l_linenumber", "active")


@query("biz_days_left", f"SELECT l_orderkey, l_linenumber, date_diff('day', DATE '{AS_OF}', valid_to) AS laufzeit FROM ({_VALID})")
def biz_days_left(t):
    return periods.days_left(_valid_rows(t), AS_OF).select("l_orderkey", "l_linenumber", "laufzeit")


@query("biz_start_period_fill", f"""
WITH {_PLAN_ACTUAL}
SELECT part, plan_part, coalesce(lift_period, plan_period) AS contract_start_period FROM actual FULL JOIN plan ON plan_part = part AND plan_period = lift_period""")
def biz_start_period_fill(t):
    rows = _plan_full(t).withColumnsRenamed({"lift_period": "contract_start_period", "plan_period": "term_plan_period"})
    return quantities.start_period_fill(rows).select("part", "plan_part", "contract_start_period")


@query("biz_period_exception", f"""
SELECT {_LINE}, CASE WHEN l_orderkey IN (7, 42, 1200) AND ({_TYPE}) IN ('TTFD', 'TTTT', 'TTTS', 'TTTM', 'TTTI')
                     THEN strftime(l_shipdate, '%Y-%m') ELSE '1998-06' END AS contract_start_period FROM lineitem""")
def biz_period_exception(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.expr(_TYPE).alias("bsark_e"), F.col("l_orderkey").alias("vbeln"),
                             F.lit("1998-06").alias("contract_start_period"), dates.date_period("l_shipdate").alias("lifting_period"))
    return periods.period_exception(rows, [7, 42, 1200]).select("l_orderkey", "l_linenumber", "contract_start_period")


# ---- movements ----

_BWART = "CASE l_returnflag WHEN 'R' THEN '602' WHEN 'A' THEN '601' END"


@query("biz_reversal_sign", f"""
SELECT {_LINE}, CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS kg, CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS l15
FROM lineitem""")
def biz_reversal_sign(t):
    return movements.reversal_sign(_lines(t, bwart=_BWART, kg="l_quantity", l15="l_extendedprice"), measures=["kg", "l15"]).drop("bwart")


@query("biz_reversal_redirect", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_returnflag = 'R' THEN o_orderstatus ELSE l_linestatus END AS posnr,
       CASE WHEN l_returnflag = 'R' THEN o_custkey ELSE l_partkey END AS matnr FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""")
def biz_reversal_redirect(t):
    rows = lookup(_lines(t, bwart=_BWART, posnr="l_linestatus", matnr="l_partkey"), t.orders, on={"l_orderkey": "o_orderkey"},
                  take={"vbfa_posnv": "o_orderstatus", "mseg_matnr": "o_custkey"})
    return movements.reversal_redirect(rows, redirect={"posnr": "vbfa_posnv", "matnr": "mseg_matnr"}).select("l_orderkey", "l_linenumber", "posnr", "matnr")


@query("biz_unit_scale", f"SELECT {_LINE}, l_quantity / 1000 AS lifting_in_to, l_extendedprice / 1000 AS lifting_in_cbm FROM lineitem")
def biz_unit_scale(t):
    return quantities.unit_scale(_lines(t, lifting_in_kg="l_quantity", lifting_in_l15="l_extendedprice")).drop("lifting_in_kg", "lifting_in_l15")


_REASON = "CASE l_returnflag WHEN 'R' THEN 'X1' WHEN 'A' THEN CASE WHEN l_linestatus = 'O' THEN '  ' ELSE '' END END"


@query("biz_rejected_removal", f"SELECT {_LINE}, {_REASON} AS abgru FROM lineitem WHERE l_returnflag <> 'R'")
def biz_rejected_removal(t):
    """Blank, empty and null reasons stay."""
    return movements.rejected_removal(_lines(t, abgru=_REASON))


@query("biz_movement_doc_fill", """
WITH docs AS (SELECT DISTINCT l_orderkey AS kdauf, l_linenumber AS kdpos, 'M' || l_orderkey AS mblnr FROM lineitem WHERE l_returnflag = 'R')
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, coalesce(mblnr, CASE WHEN l_linestatus = 'O' THEN 'D' || l_orderkey END) AS mblnr
FROM lineitem LEFT JOIN docs ON kdauf = l_orderkey AND kdpos = l_linenumber""")
def biz_movement_doc_fill(t):
    docs = t.lineitem.where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("kdauf"), F.col("l_linenumber").alias("kdpos"), F.expr("'M' || CAST(l_orderkey AS STRING)").alias("mblnr"))
    rows = _lines(t, material_dn="CASE WHEN l_linestatus = 'O' THEN 'D' || CAST(l_orderkey AS STRING) END")
    return movements.movement_doc_fill(rows, docs.distinct(), order="l_orderkey", item="l_linenumber").drop("material_dn")


@query("biz_load_id_backfill", """
SELECT event_id, user_id, coalesce(CASE WHEN event_type = 'click' THEN 'L' || event_id END, 'A' || k) AS load_id,
       coalesce(CASE WHEN event_type = 'view' THEN 'P' || event_id END, seg) AS license_plate, coalesce(NULL, nm) AS driver_text
FROM events LEFT JOIN (SELECT c_custkey AS k, c_mktsegment AS seg, c_name AS nm FROM customer WHERE c_mktsegment <> 'BUILDING') ON k = user_id""")
def biz_load_id_backfill(t):
    extract = t.customer.where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("material_document_number_a"), F.col("c_custkey").alias("material_number_a"), F.col("c_custkey").alias("contract_number"),
        F.expr("'A' || CAST(c_custkey AS STRING)").alias("load_id_a"), F.col("c_mktsegment").alias("license_plate_a"), F.col("c_name").alias("driver_text_a"))
    rows = t.events.select(
        "event_id", "user_id", *[F.col("user_id").alias(c) for c in ("material_document_number", "material_number", "contract_no")],
        F.expr("CASE WHEN event_type = 'click' THEN 'L' || CAST(event_id AS STRING) END").alias("load_id"),
        F.expr("CASE WHEN event_type = 'view' THEN 'P' || CAST(event_id AS STRING) END").alias("license_plate"), F.lit(None).cast("string").alias("driver_text"))
    return movements.load_id_backfill(rows, extract).select("event_id", "user_id", "load_id", "license_plate", "driver_text")


@query("biz_incoterm_merge", f"""
WITH {_PLAN_ACTUAL}
SELECT part, plan_part, coalesce(CASE WHEN lifted > 20 THEN 'FOB' END, CASE WHEN planned > 20 THEN 'FCA' END) AS incoterm
FROM actual FULL JOIN plan ON plan_part = part AND plan_period = lift_period""")
def biz_incoterm_merge(t):
    rows = _plan_full(t).select("part", "plan_part", F.when(F.col("lifted") > 20, "FOB").alias("incoterm_1"),
                                F.when(F.col("planned") > 20, "FCA").alias("plan_incoterm"))
    return movements.incoterm_merge(rows)


# ---- parties ----


@query("biz_sales_group", """
WITH area AS (SELECT kunnr, min(vkgrp) AS vkgrp FROM (
                SELECT c_custkey AS kunnr, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'G' || c_nationkey END AS vkgrp FROM customer
                UNION ALL SELECT c_custkey, 'F' || c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING') WHERE vkgrp IS NOT NULL GROUP BY 1),
sheet AS (SELECT s_suppkey AS partner, 'K' || s_nationkey AS grp FROM supplier)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, coalesce(a.vkgrp, sa.grp) AS si, coalesce(b.vkgrp, sb.grp) AS kam
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN area a ON a.kunnr = l_suppkey LEFT JOIN sheet sa ON sa.partner = l_suppkey
LEFT JOIN area b ON b.kunnr = o_custkey LEFT JOIN sheet sb ON sb.partner = o_custkey""")
def biz_sales_group(t):
    text = lambda c: F.col(c).cast("string")
    area = t.customer.select(F.lpad(text("c_custkey"), 16, "0").alias("kunnr"), F.lit("DE01").alias("vkorg"),
                             F.expr("CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'G' || CAST(c_nationkey AS STRING) END").alias("vkgrp"))
    area = area.unionByName(t.customer.where("c_mktsegment = 'BUILDING'").select(
        F.lpad(text("c_custkey"), 16, "0").alias("kunnr"), F.lit("DE01").alias("vkorg"), F.expr("'F' || CAST(c_nationkey AS STRING)").alias("vkgrp")))
    sheet = t.supplier.select(F.lpad(text("s_suppkey"), 12, "0").alias("partner"), F.expr("'K' || CAST(s_nationkey AS STRING)").alias("partner_sales_group"))
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "l_orderkey", "l_linenumber", F.expr("ltrim('0', lpad(CAST(l_suppkey AS STRING), 16, '0'))").alias("ship_to_number"),
        F.expr("ltrim('0', lpad(CAST(o_custkey AS STRING), 16, '0'))").alias("sold_to_number"))
    return parties.sales_group(rows, area, sheet).select("l_orderkey", "l_linenumber", "si", "kam")


@query("biz_national_account", """
SELECT o_orderkey, coalesce(n_name, CASE WHEN o_orderstatus <> 'P' THEN c.c_name END) AS national_account_name
FROM orders LEFT JOIN customer c ON c.c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c.c_nationkey AND c.c_mktsegment <> 'BUILDING'""")
def biz_national_account(t):
    text = lambda c: F.col(c).cast("string")
    partners = t.customer.select(text("c_custkey").alias("kunnr"), F.when(F.col("c_mktsegment") != "BUILDING", text("c_nationkey")).alias("kunn2"))
    partners = partners.withColumn("kunnr", F.when(F.col("kunnr") != "0", F.col("kunnr")).otherwise(""))
    names = t.nation.select(text("n_nationkey").alias("kunnr"), F.col("n_name").alias("name1"))
    orders = lookup(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), t.customer, on={"o_custkey": "c_custkey"}, take={"sold_to_name": "c_name"})
    rows = orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("sold_to_name")).alias("sold_to_name"),
                         F.when(F.col("o_custkey") != 0, text("o_custkey")).otherwise("").alias("sold_to_number"))
    return parties.account_name_fill(parties.national_account(rows, partners, names)).select("o_orderkey", "national_account_name")


@query("biz_invoice_delivery", """
SELECT DISTINCT billing_date, delivery_number, billing_document, invoice_type_name FROM (
  SELECT o_orderpriority AS invoice_type, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS billing_date, CASE WHEN l_orderkey = 0 THEN '' ELSE l_orderkey::VARCHAR END AS delivery_number,
         l_linestatus AS si, min('I' || l_linenumber) AS billing_document
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3, 4)
JOIN (SELECT DISTINCT o_orderpriority AS gsap_code, 'Type ' || o_orderpriority AS invoice_type_name FROM orders WHERE o_orderpriority <> '5-LOW') ON gsap_code = invoice_type""")
def biz_invoice_delivery(t):
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderpriority").alias("invoice_type"), F.col("o_orderdate").cast("date").alias("billing_date"),
        F.lpad(F.col("l_orderkey").cast("string"), 16, "0").alias("delivery_number"), F.col("l_linestatus").alias("si"),
        F.expr("'I' || CAST(l_linenumber AS STRING)").alias("invoice_number"))
    mapping = t.orders.where("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderpriority").alias("gsap_code"), F.concat(F.lit("Type "), "o_orderpriority").alias("invoice_type_name")).distinct()
    return parties.invoice_delivery(rows, mapping)
