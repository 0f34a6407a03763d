"""Contract, movement, billing and plan tables derived from the given tables.

Each text is plain SQL that Spark and other engines read alike; the names in
braces are the given tables. Codes are padded the way the sources pad them.
"""

from __future__ import annotations

from liftplan.session import stage
from liftplan.sources import Catalog

# Code widths: wide enough for the keys of the largest scale, so that no two
# keys share a code.
GIVEN = ("customer", "supplier", "part", "orders", "lineitem", "items")
ORDER, DOC, PARTY, MATERIAL, PLANT = 16, 15, 14, 24, 12


def _ymd(e: str) -> str:
    return f"replace(cast(cast({e} as date) as string), '-', '')"


def _later(e: str, days: int) -> str:
    return f"cast(cast({e} as date) + interval {days} day as date)"


def _code(e: str, width: int) -> str:
    return f"lpad(cast({e} as string), {width}, '0')"


def _plant(key: str, third: str = "D361") -> str:
    return f"case when {key} = 3 then '{third}' else 'P' || {_code(key, PLANT)} end"


# One row per order and line. Flags are ranked as numbers, which aggregate
# without a sort, and named again afterwards.
_ITEMS = """
select k, n, part, supp, qty, case flag when 1 then 'A' when 2 then 'N' when 3 then 'R' end as flag,
       case status when 1 then 'F' else 'O' end as status, shipped, discount, tax
from (select l_orderkey as k, l_linenumber as n, min(l_partkey) as part, min(l_suppkey) as supp, sum(l_quantity) as qty,
             min(case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end) as flag,
             min(case l_linestatus when 'F' then 1 else 2 end) as status,
             max(l_shipdate) as shipped, min(l_discount) as discount, min(l_tax) as tax
      from {lineitem} group by l_orderkey, l_linenumber) g"""


def _header(days: str, batch: str, where: str) -> str:
    return f"""
select {_code('o_orderkey', ORDER)} as vbeln, {_ymd('o_orderdate')} as guebg,
       case when o_orderpriority = '1-URGENT' then {_ymd('o_orderdate')} else {days} end as gueen,
       {_ymd('o_orderdate')} as erdat, '093000' as erzet, o_orderstatus as ctlpc,
       case when o_orderstatus = 'P' then 'ZCRM' else 'ZCQ' end as auart,
       case o_orderpriority when '1-URGENT' then '10' when '2-HIGH' then '30' when '3-MEDIUM' then '20'
            when '4-NOT SPECIFIED' then '80' else '99' end as vsbed,
       '02' as vtweg, 'D' || o_orderstatus as oid_miscdl, {_code('o_custkey', PARTY)} as kunnr,
       {_code('o_orderkey', ORDER)} as knumv, nullif(o_orderpriority, '3-MEDIUM') as ktext,
       case when o_orderpriority = '5-LOW' then 'AT01' else 'DE01' end as vkorg, {batch} as batch_time
from {{orders}} {where}"""


def _months(prefix: str, names: list[str]) -> str:
    return ", ".join(f"sum(case when extract(month from o_orderdate) = {i} then l_quantity end) as {prefix}{m}"
                     for i, m in enumerate(names, start=1))


MONTH_NAMES = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_PLAN_LABELS = f"""
case when p_size > 30 then 'FOB' when p_size > 5 then 'FCA' else null end as incoterm,
case p_type when 'SMALL' then 'ITT' when 'LARGE' then 'Barge' when 'PROMO' then 'Rail'
     when 'MEDIUM' then null else 'Truck' end as mot,
{_plant('l_suppkey', 'D333')} as supply_point,
case when p_size > 25 then ' back-up ' when p_size > 10 then 'main' end as depot_property,
case when p_size > 20 then 0.5e0 else 0.8e0 end as density,
case when p_brand < 'Brand#14' then 'Trigger' when p_brand < 'Brand#19' then 'Half-Month'
     when p_brand < 'Brand#23' then 'Decade' when p_brand < 'Brand#5' then 'Monthly' end as pricing_period,
'12M' as agreemt_period, nullif(p_brand, 'Brand#7') as fed_contract,
{_code('l_suppkey', PARTY - 2)} as sold_to_number, {_code('l_suppkey', PARTY - 2)} as ship_to_number,
{_code('l_partkey', MATERIAL - 9)} as material_number, p_name as price_basis"""

DOMAIN_SQL: dict[str, str] = {
    "contract_header": _header(_ymd(_later("o_orderdate", 60)), "o_orderdate", "")
    + "\nunion all\n" + _header(_ymd(_later("o_orderdate", 50)), "o_orderdate - interval 1 day",
                                "where o_orderstatus = 'O'"),
    "contract_item": f"""
select {_code('k', ORDER)} as vbeln, {_code('n', 6)} as posnr, {_code('part', MATERIAL)} as matnr,
       qty as volum, {_code('supp', PARTY)} as oid_ship, {_plant('supp')} as vbap_werks, discount as umzin,
       case when tax > 0.07 then 'X1' when tax > 0.06 then '  ' when tax > 0.05 then '' end as abgru,
       'L' as voleh, qty * 10 as zmeng,
       case flag when 'A' then 'TO' when 'N' then 'M15' else 'L15' end as zieme, 'DE01' as bukrs
from {{items}} i""",
    "document_flow": f"""
select 'S' || {_code('o_orderkey', DOC)} as vbeln, {_code('o_orderkey', ORDER)} as vbelv, '000001' as posnv,
       '02' as vtweg, 'DE01' as vkorg from {{orders}}
union all
select 'M' || {_code('o_orderkey', DOC)} as vbeln, 'S' || {_code('o_orderkey', DOC)} as vbelv, '000001' as posnv,
       '01' as vtweg, 'DE01' as vkorg from {{orders}} where o_orderstatus <> 'P'""",
    "contract_commercial": f"""
select {_code('k', ORDER)} as vbeln, {_code('n', 6)} as posnr,
       case when status = 'O' and flag = 'A' then 'TTTT' when status = 'O' and flag = 'N' then 'TTFD'
            when status = 'O' then '' when flag = 'A' then 'TSFP' when flag = 'N' then 'TTTS' end as bsark_e,
       'DE01' as bukrs
from {{items}} i""",
    # Header-level forms of the two tables above and below, for joins that know no item.
    "contract_commercial_head": f"""
select {_code('o_orderkey', ORDER)} as vbeln,
       case o_orderpriority when '1-URGENT' then 'TTFD' when '2-HIGH' then '' when '3-MEDIUM' then 'TSFP' end as bsark_e
from {{orders}}""",
    "price_condition_head": f"""
select {_code('o_orderkey', ORDER)} as knumv, '000000' as kposn,
       case o_orderpriority when '1-URGENT' then 'YP03' when '2-HIGH' then 'YP10' when '5-LOW' then 'YP24' else 'XX01' end as kschl
from {{orders}}""",
    "price_condition": f"""
select {_code('k', ORDER)} as knumv, {_code('n', 6)} as kposn,
       case when tax > 0.06 then 'YP03' when tax > 0.03 then 'YP10' when tax > 0.01 then 'YP23'
            when tax > 0 then '' else 'XX01' end as kschl, 'DE01' as bukrs
from {{items}} i""",
    "billing_item": f"""
select 'I' || {_code('o_orderkey', DOC)} as vbeln, '000010' as posnr, 'S' || {_code('o_orderkey', DOC)} as aubel,
       'T1' as oic_ptrip, {_code('o_orderkey', ORDER)} as oid_miscdl, 'DE01' as vkorg, '02' as vtweg
from {{orders}} where o_orderstatus <> 'O'
union all
select 'I' || {_code('o_orderkey', DOC)} as vbeln, '000020' as posnr, 'S' || {_code('o_orderkey', DOC)} as aubel,
       'T2' as oic_ptrip, {_code('o_orderkey', ORDER)} as oid_miscdl, 'DE01' as vkorg, '02' as vtweg
from {{orders}} where o_orderpriority <> '2-HIGH'""",
    "billing_header": f"""
select 'I' || {_code('o_orderkey', DOC)} as vbeln, {_code('o_orderkey', ORDER)} as knumv, o_orderpriority as fkart,
       'Z30' as zterm, 'B' as zlsch, {_ymd('o_orderdate')} as erdat, '02' as vtweg, 'DE01' as vkorg
from {{orders}}""",
    "customer_name": f"""
select {_code('c_custkey', PARTY)} as kunnr,
       case c_mktsegment when 'FURNITURE' then '' when 'MACHINERY' then null else c_name end as name1
from {{customer}}""",
    "customer_partner": f"""
select {_code('c_custkey', PARTY)} as kunnr,
       case when c_mktsegment <> 'BUILDING' then {_code('c_nationkey', PARTY)} end as kunn2,
       '02' as vtweg, 'DE01' as vkorg from {{customer}}""",
    "customer_sales_area": f"""
select {_code('c_custkey', PARTY)} as kunnr, 'DE01' as vkorg,
       case when c_mktsegment <> 'HOUSEHOLD' then 'G' || cast(c_nationkey as string) end as vkgrp from {{customer}}
union all
select {_code('c_custkey', PARTY)} as kunnr, 'DE01' as vkorg, 'H' || cast(c_nationkey as string) as vkgrp
from {{customer}} where c_mktsegment = 'BUILDING'""",
    "sales_group_mapping": f"""
select {_code('s_suppkey', PARTY)} as partner, 'K' || cast(s_nationkey as string) as partner_sales_group,
       {_code('s_suppkey', PARTY)} as customer, 'S' as sales_group_sp from {{supplier}}""",
    "material_master": """
select cast(p_partkey as string) as matnr, p_type as prod_group_desc, p_brand as prod_subgroup, p_name as grade
from {part}""",
    "material_mapping": """
select cast(p_partkey as string) as material_number,
       case p_type when 'STANDARD' then 'Mogas' when 'SMALL' then 'GtL' when 'LARGE' then 'AGO'
            when 'PROMO' then 'IGO' when 'ECONOMY' then 'FSD' end as product_subgroup,
       p_brand as subgrade, p_name as base_grade from {part}""",
    "site": f"select {_plant('s_suppkey')} as werks, s_name as name1 from {{supplier}}",
    "movement": f"""
select 'M' || {_code('k', DOC)} as mblnr, {_code('n', 4)} as zeile, 'S' || {_code('k', DOC)} as kdauf,
       {_code('n', 6)} as kdpos, {_code('k', ORDER)} as ebeln, {_code('part', MATERIAL)} as matnr,
       {_plant('supp')} as werks, 'DE01' as bukrs,
       case flag when 'R' then '602' when 'A' then '601' when 'N' then '101' else '999' end as bwart,
       {_ymd('shipped')} as zxbldat, {_ymd('shipped')} as zxbudat, '101500' as zxoib_bltime,
       status as oihantyp, 'B' || flag as oid_extbol, shipped as ca_last_mdf, {_code('k', ORDER)} as oivbeln,
       case when flag <> 'N' then 'TR�' || flag end as oic_ptrip,
       case when status = 'F' then 'DRV' end as oid_miscdl, {_code('n', 6)} as oiposnr
from {{items}} i""",
    "movement_quantity": f"""
select 'M' || {_code('k', DOC)} as mblnr, ' ' || {_code('n', 4)} || ' ' as zeile, 'KG' as msehi,
       qty * 1000 as adqnt, 'DE01' as bukrs from {{items}} i where discount > 0
union all
select 'M' || {_code('k', DOC)} as mblnr, ' ' || {_code('n', 4)} || ' ' as zeile, 'L15' as msehi,
       qty * 1250 as adqnt, 'DE01' as bukrs from {{items}} j
union all
select 'M' || {_code('k', DOC)} as mblnr, ' ' || {_code('n', 4)} || ' ' as zeile, 'ST' as msehi,
       qty as adqnt, 'DE01' as bukrs from {{items}} l""",
    "purchase_header": f"""
select {_code('o_orderkey', ORDER)} as ebeln, {_ymd('o_orderdate')} as aedat,
       case o_orderstatus when 'F' then 'FCA' when 'O' then 'FOB' end as inco1, o_orderpriority as inco2
from {{orders}}""",
    "load_registry": f"""
select {_code('l_suppkey', PARTY)} as lidno, l_returnflag as lid3cod1,
       {_code('l_orderkey', ORDER)} || {_code('l_linenumber', 6)} as lidaddon, l_shipdate as ca_timestamp
from {{lineitem}} where l_returnflag <> 'N'""",
    "price_audit": f"""
select {_code('l_orderkey', ORDER)} as sap_contract_number, 'H' || {_code('l_orderkey', DOC)} as sht_number,
       {_code('l_partkey', MATERIAL)} as material_no, {_plant('l_suppkey')} as plant_no,
       sum(l_quantity) * 2 as volume_cbm, max(l_shipdate) as createddate
from {{lineitem}} where l_returnflag <> 'R' group by l_orderkey, l_partkey, l_suppkey""",
    "invoice_type_mapping": """
select distinct o_orderpriority as gsap_code, 'Type ' || substring(o_orderpriority, 1, 1) as invoice_type_name
from {orders} where o_orderpriority <> '5-LOW'""",
    "backfill_extract": f"""
select 'M' || {_code('k', DOC)} as material_document_number_a, cast(part as string) as material_number_a,
       cast(k as string) as contract_number, 'L' || cast(supp as string) as load_id_a,
       'DRIVER ' || flag as driver_text_a, 'PLATE ' || status as license_plate_a
from {{items}} i""",
    "plan_2022": f"""
select s_name as sold_to_name, {_PLAN_LABELS}, 'open' as tracking_status,
       case l_linestatus when 'O' then 'active' else 'closed' end as contract_status, {_months('planvol_', MONTH_NAMES)}
from {{lineitem}} join {{orders}} on o_orderkey = l_orderkey join {{part}} on p_partkey = l_partkey
     join {{supplier}} on s_suppkey = l_suppkey
where extract(year from o_orderdate) = 1998
group by s_name, l_suppkey, l_partkey, p_size, p_type, p_brand, p_name, l_linestatus""",
    "plan_2023": f"""
select {_PLAN_LABELS}, cast('1999-01-01' as date) as contract_start_date,
       case l_linestatus when 'O' then cast('1999-12-31' as date) else cast('2000-01-31' as date) end as contract_end_date,
       {_months('plancbm_', ['april' if m == 'apr' else m for m in MONTH_NAMES])}
from {{lineitem}} join {{orders}} on o_orderkey = l_orderkey join {{part}} on p_partkey = l_partkey
where extract(year from o_orderdate) = 1999
group by l_suppkey, l_partkey, p_size, p_type, p_brand, p_name, l_linestatus""",
}


#: Keys of the derived tables, as their sources declare them.
DOMAIN_KEYS: dict[str, list[tuple[str, ...]]] = {
    "contract_item": [("vbeln", "posnr")],
    "document_flow": [("vbelv", "vbeln")],
    "contract_commercial": [("vbeln", "posnr")],
    "contract_commercial_head": [("vbeln",)],
    "price_condition": [("knumv", "kposn", "kschl")],
    "price_condition_head": [("knumv", "kposn", "kschl")],
    "billing_item": [("vbeln", "posnr")],
    "billing_header": [("vbeln",)],
    "customer_name": [("kunnr",)],
    "material_master": [("matnr",)],
    "site": [("werks",)],
    "movement": [("mblnr", "zeile")],
    "purchase_header": [("ebeln",)],
}


def domain_catalog(inputs) -> Catalog:
    """Catalog of the derived tables, opened by Spark.

    The items have many readers, so they are written once to the scratch area.
    """
    def opened(text: str):
        names = [t for t in GIVEN if "{" + t + "}" in text]
        return lambda: inputs.spark.sql(text, **{t: getattr(inputs, t) for t in names})

    catalog = Catalog()
    for name, text in DOMAIN_SQL.items():
        catalog.bind(name, opened(text), DOMAIN_KEYS.get(name, ()))
    return catalog


def domain_cte(name: str) -> str:
    """The derived table as a common table expression for the SQL side."""
    names = {t: t for t in GIVEN}
    text = _ITEMS if name == "items" else DOMAIN_SQL[name]
    return f"{name} as ({text.format(**names)})"


def items(inputs):
    """One row per order and line, written once."""
    return stage(inputs.spark.sql(_ITEMS, lineitem=inputs.lineitem), "items")
