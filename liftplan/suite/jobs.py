"""Queries for the batch jobs, run over the derived contract tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from liftplan.operators.aggregate import reconcile
from liftplan.plans import (
    contract_raw, contract_summary, delivery_mapping, history, ingest, movements, plan, prototypes,
)
from liftplan.session import scratch_path, stage, staging
from liftplan.sources import Catalog, TableSpec, read_table, replace as write_table, write_outputs
from liftplan.suite.job_sql import MOVED, SUMMED, ties, with_ctes
from liftplan.suite.joins import _VERSIONS, _versions
from liftplan.suite.registry import AS_OF, query, rounded
from liftplan.suite.scans import PART_SCHEMA

# Plant codes of the derived tables.
MERGED_PLANTS = {"D333": "D361"}
MOVEMENT = movements.MovementOptions(first_day="1995-01-01")
CONTRACT = contract_raw.ContractOptions(movement=MOVEMENT)
SUMMARY = contract_summary.SummaryOptions(
    contract=CONTRACT, halved_ship_tos=("7", "9"), unhalved_plants=("P000000000009",), write_at=f"{AS_OF} 08:30:00")
MAPPING = delivery_mapping.MappingOptions(contract=CONTRACT, composite_widths=(16, 6), write_at=f"{AS_OF} 08:30:00")
LIFTED = ["lifting_in_kg", "lifting_in_l15", "lifting_in_to", "lifting_in_cbm"]


def _text(columns: str) -> str:
    return ", ".join(f"CAST({c.strip()} AS VARCHAR) AS {c.strip()}" if c.strip() == "ca_last_mdf" else c.strip() for c in columns.split(","))


def _round(*columns: str) -> str:
    return ", ".join(f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' for c in columns)


def _without(columns: str, *dropped: str) -> str:
    return ", ".join(c.strip() for c in columns.split(",") if c.strip() not in dropped)


@query("job_movements", with_ctes(f"SELECT {_text(_without(MOVED, 'ca_last_mdf'))}, aedat, inco1, inco2, lifting_period, {_round(*LIFTED)} FROM lifted"))
def job_movements(t):
    return rounded(movements.run(t.spark, t.domain, AS_OF, MOVEMENT)["movements"].drop("ca_last_mdf"))


@query("job_contract_raw_summed", with_ctes(
    f"SELECT {_without(SUMMED, *LIFTED, 'zmeng')}, plant_name, {_round('zmeng', *LIFTED)} FROM contract_rows"))
def job_contract_raw_summed(t):
    return rounded(contract_raw.run_summed(t.spark, t.domain, AS_OF, CONTRACT, staged=True)["contract_rows"])


_MAPPED = """vbeln, guebg, gueen, erdat, erzet, ctlpc, auart, vsbed, vtweg, kunnr, knumv, ktext, oid_ship, abgru, zieme, vbap_bukrs, mseg_so, vbfa_posnv,
 material_dn, bsark_e, mblnr, posnr, matnr, vbap_werks, contract_start_period, contract_end_period, oihantyp, ebeln, mseg_matnr, bukrs, zxbldat, bwart,
 oid_extbol, zxoib_bltime, oivbeln, oic_ptrip, oid_miscdl, oiposnr, mseg_werks, aedat, inco1, inco2, lifting_period, sold_to_name, ship_to_name,
 invoice_number, vbrp_position_number, vbrp_sales_contract_number, vkorg, vbrk_knumv, fkart, zterm, zlsch, billing_date, kschl, pricing_scheme,
 prod_group_desc, prod_subgroup, grade, plant_name"""


@query("job_contract_raw_mapped", with_ctes(f"SELECT {_MAPPED}, {_round('zmeng', *LIFTED)} FROM mapped_rows"))
def job_contract_raw_mapped(t):
    return rounded(contract_raw.run_mapped(t.spark, t.domain, AS_OF, CONTRACT, staged=True)["mapped_rows"].drop("ca_last_mdf"))


_PLAN_TEXT = """incoterm, mot, supply_point, depot_property, pricing_period, agreemt_period, fed_contract, sold_to_number, ship_to_number, material_number,
 term_plan_period, price_basis, shipping_condition_term"""


def _plans(t, year):
    if year == 2022:
        return plan.run_2022(t.spark, t.domain, replace(plan.PLAN_2022, year=1998, plant_merges=MERGED_PLANTS))["plan"]
    return plan.run_2023(t.spark, t.domain, replace(plan.PLAN_2023, year=1999, plant_merges=MERGED_PLANTS))["plan"]


@query("job_plan_2022", with_ctes(f"SELECT {_PLAN_TEXT}, {_round('density', 'plan_m3', 'plan_to')} FROM plan22"))
def job_plan_2022(t):
    return rounded(_plans(t, 2022))


@query("job_plan_2023", with_ctes(f"SELECT {_PLAN_TEXT}, {_round('density', 'plan_m3', 'plan_to')} FROM plan23"))
def job_plan_2023(t):
    return rounded(_plans(t, 2023))


def _with_plan(t) -> Catalog:
    """The plan jobs store their result; the jobs after them read it."""
    return t.domain.bind("plan_period", stage(_plans(t, 2022).unionByName(_plans(t, 2023)), "plan-period"))


def _written(t, job, *names):
    """The job's outputs through ``write_outputs``, read back from where they were stored."""
    catalog = Catalog({n: TableSpec("parquet", scratch_path(t.spark, f"out-{n}")) for n in names})
    rows = write_outputs(t.spark, job, {n: catalog.spec(n) for n in names})
    made = {n: read_table(t.spark, catalog, n) for n in names}
    if rows != {n: df.count() for n, df in made.items()}:
        raise ValueError(f"rows counted while writing {rows} are not those stored")
    return made


_SUMMARY_TEXT = """agreemt_period, company_code, contract_description, contract_end_period, contract_no, contract_item, purchase_order_type, contract_start_period,
 depot_property, fed_contract, grade, kam, last_modefied_date, material_number, mot, national_account_name, plant_code, price_basis, pricing_period,
 pricing_scheme, sales_doc_type, ship_to_number, si, sold_to_number, term_plan_period, uom, shipping_condition_tbu, plant_name, sold_to_name, ship_to_name,
 valid_from_formatted, valid_to_formatted"""
_SUMMARY_DATES = ("valid_from", "valid_to", "creation_date")
_SUMMARY_NUMBERS = ("density", "avg_target_quantity", "avg_plan_m3", "avg_plan_to", "sum_lifting_in_l15", "sum_lifting_in_kg", "sum_lifting_in_to",
                    "sum_lifting_in_cbm", "trigger_contract_num_plan", "trigger_contract_num_plan_to", "target_qty_to", "target_qty_m3", "tolerance_m15",
                    "erfullt_zu", "fullcalc_phil", "open_qty_m3")
_SUMMARY_ONLY = ("sum_fullcalc_phil", "sum_sum_lifting_in_cbm", "erfüllung", "fullfillment_vs_plan", "fullfillment_vs_target", "laufzeit")
_FINISHED_TEXT = ("key", "produkt", "abholzeitraum", "active")
_DATES_SQL = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _SUMMARY_DATES)


@query("job_contract_summary", with_ctes(f"""
SELECT 'contract_summary' AS output, {_SUMMARY_TEXT}, {_DATES_SQL}, {_round(*_SUMMARY_NUMBERS)}, '1998-06-15 09:30:00' AS write_timestamp,
  NULL AS subgrade, CAST(NULL AS DOUBLE) AS volume_cbm, {_round(*_SUMMARY_ONLY)}, {', '.join(_FINISHED_TEXT)} FROM summary_rows
UNION ALL BY NAME
SELECT DISTINCT 'deals_without_contract' AS output, {_SUMMARY_TEXT}, {_DATES_SQL}, {_round(*_SUMMARY_NUMBERS)}, '1998-06-15 09:30:00' AS write_timestamp,
  subgrade, {_round('volume_cbm')} FROM fulfilment WHERE contract_no IS NULL"""))
def job_contract_summary(t):
    """Both outputs, told apart by ``output``."""
    made = _written(t, lambda: contract_summary.run(t.spark, _with_plan(t), AS_OF, SUMMARY), "contract_summary", "deals_without_contract")
    whole = made["contract_summary"].withColumns(
        {c: F.col(c).cast("double") for c in ("avg_plan_m3", "fullcalc_phil", "tolerance_m15", "laufzeit")})
    both = whole.withColumn("output", F.lit("contract_summary")).unionByName(
        made["deals_without_contract"].withColumn("output", F.lit("deals_without_contract")), allowMissingColumns=True)
    return rounded(both)


# Columns of the shared delivery rows, by name, for ties.
_SHARED = sorted("""vbap_bukrs sales_order vbfa_posnv material_dn purchase_order_type material_document_number item_number material_number plant_code
contract_start_period contract_end_period handling_type ebeln mseg_matnr company_code movement_type oid_extbol loading_time ca_last_mdf delivery_number
license_plate driver_text oiposnr mseg_werks last_modified_date incoterm incoterm_name lifting_in_kg lifting_in_l15 lifting_in_to lifting_in_cbm
lifting_period sold_to_name ship_to_name invoice_number vbrp_position_number vbrp_sales_contract_number vkorg vbrk_knumv invoice_type payment_term
payment_method billing_date kschl pricing_scheme product_group_description prod_subgroup grade plant_name contract_no valid_from valid_to
contract_creation_period contract_created_time risk_category sales_doc_type shipping_condition distribution_channel sold_to_number
document_position_number contract_description ship_to_number reason_for_rejection target_quantity uom loading_date pot_manual_update
loading_date_formatted mot supply_point plan_m3 depot_property density pricing_period agreemt_period fed_contract term_plan_period plan_to
shipping_condition_term price_basis sht_number volume_cbm created_date_time load_id third_party_code si""".split())
_DELIVERY_KEYS = ("contract_no", "material_document_number", "material_number", "delivery_number", "loading_date")


def _date(c):
    return f"CAST(try_strptime({c}, '%Y%m%d') AS DATE)"


_BUSINESS = f"""
SELECT inco1 AS incoterm_1, inco2 AS incoterm_name, ltrim(kunnr, '0') AS sold_to_number, ltrim(oid_ship, '0') AS ship_to_number, {_date('guebg')} AS valid_from,
  {_date('gueen')} AS valid_to, substr(erdat, 1, 4) || '-' || substr(erdat, 5, 2) AS contract_creation_period, erzet AS contract_created_time, ctlpc AS risk_category,
  auart AS sales_doc_type, vsbed AS shipping_condition, oid_miscdl AS driver_text, ltrim(knumv, '0') AS document_position_number, ktext AS contract_description,
  zmeng AS target_quantity, ltrim(posnr, '0') AS item_number, vbap_werks AS plant_code, bsark_e AS purchase_order_type, prod_group_desc AS product_group_description,
  oic_ptrip AS license_plate, fkart AS invoice_type, zterm AS payment_term, zlsch AS payment_method, oihantyp AS handling_type, mblnr AS material_document_number,
  ltrim(matnr, '0') AS material_number, bukrs AS company_code, {_date('zxbldat')} AS loading_date, bwart AS movement_type, aedat AS last_modified_date,
  vtweg AS distribution_channel, '10:15:00' AS loading_time, abgru AS reason_for_rejection, ltrim(vbeln, '0') AS contract_no, zieme AS uom,
  ltrim(mseg_so, '0') AS sales_order, oivbeln AS delivery_number, CASE WHEN bsark_e IS NULL THEN 'Yes' ELSE 'No' END AS pot_manual_update,
  lifting_in_kg, lifting_in_l15, lifting_in_kg / 1000 AS lifting_in_to, lifting_in_l15 / 1000 AS lifting_in_cbm, substr(zxbldat, 1, 4) || '-' || substr(zxbldat, 5, 2) AS lifting_period,
  {_date('billing_date')} AS billing_date, substr(zxbldat, 7) || '.' || substr(zxbldat, 5, 2) || '.' || substr(zxbldat, 1, 4) AS loading_date_formatted,
  vbap_bukrs, vbfa_posnv, material_dn, contract_start_period, contract_end_period, ebeln, mseg_matnr, oid_extbol, ca_last_mdf, oiposnr, mseg_werks, sold_to_name, ship_to_name,
  invoice_number, vbrp_position_number, vbrp_sales_contract_number, vkorg, vbrk_knumv, kschl, pricing_scheme, prod_subgroup, grade, plant_name
FROM mapped_rows WHERE vbeln IS NOT NULL"""
_SHARED_SQL = f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(_DELIVERY_KEYS)} ORDER BY {ties([c for c in _SHARED if c not in _DELIVERY_KEYS])}) AS rn FROM (
  SELECT b.* EXCLUDE (incoterm_1), coalesce(b.incoterm_1, p.incoterm) AS incoterm, p.* EXCLUDE (incoterm, ship_to_number, material_number),
    a.sht_number, a.volume_cbm, a.created_date_time, l.load_id, l.third_party_code, g.partner_sales_group AS si
  FROM ({_BUSINESS}) b
  FULL JOIN (SELECT DISTINCT incoterm, ship_to_number, material_number, mot, supply_point, plan_m3, depot_property, density, pricing_period, agreemt_period, fed_contract,
             term_plan_period, plan_to, shipping_condition_term, price_basis FROM plan_period) p
    ON p.ship_to_number = b.ship_to_number AND p.material_number = b.material_number AND p.supply_point = b.plant_code AND p.term_plan_period = b.contract_start_period
  LEFT JOIN (SELECT DISTINCT ltrim(sap_contract_number, '0') AS c, ltrim(material_no, '0') AS m, plant_no, sht_number, volume_cbm, min(createddate) AS created_date_time
             FROM price_audit GROUP BY ALL) a ON a.c = b.contract_no AND a.m = b.material_number AND a.plant_no = b.plant_code
  LEFT JOIN (SELECT ltrim(lidno, '0') AS load_id, lid3cod1 AS third_party_code, ltrim(substr(lidaddon, 1, 16), '0') AS contractno, ltrim(substr(lidaddon, 17, 6), '0') AS item_num
             FROM (SELECT *, row_number() OVER (PARTITION BY lidaddon ORDER BY ca_timestamp DESC, lidno, lid3cod1) AS rn FROM load_registry) WHERE rn = 1) l
    ON l.contractno = b.contract_no AND l.item_num = b.item_number
  LEFT JOIN group_sheet g ON g.partner = b.ship_to_number WHERE b.contract_no IS NOT NULL)) WHERE rn = 1"""
_MAPPING_NUMBERS = ("target_quantity", "plan_m3", "density", "plan_to", "volume_cbm", *LIFTED)
_MAPPING_DATES = ("valid_from", "valid_to", "loading_date", "billing_date")
_TECHNICAL = ("vbrp_sales_contract_number", "vbap_bukrs", "ebeln", "vbrp_position_number", "vbrk_knumv", "vkorg", "mseg_matnr", "oiposnr", "mseg_werks",
              "kschl", "vbfa_posnv", "material_dn")
_OVERRIDDEN = ("delivery_number", "mot", "load_id", "license_plate", "driver_text", "ca_last_mdf", "created_date_time")
_PLAIN = [c for c in _SHARED if c not in (*_MAPPING_NUMBERS, *_MAPPING_DATES, *_TECHNICAL, *_OVERRIDDEN)]


@query("job_delivery_mapping", with_ctes(f"""
, shared AS ({_SHARED_SQL})
SELECT DISTINCT 'delivery_mapping' AS output, {', '.join(f's.{c}' for c in _PLAIN)}, {', '.join(f'round(CAST(s.{c} AS DOUBLE), 6) AS {c}' for c in _MAPPING_NUMBERS)},
  {', '.join(f'CAST(s.{c} AS VARCHAR) AS {c}' for c in _MAPPING_DATES)}, ltrim(delivery_number, '0') AS delivery_number,
  concat_ws('', contract_no, plant_code, s.material_number, term_plan_period) AS key, base_grade,
  CASE WHEN shipping_condition IN ('30', '31', '40', '41') THEN 'Barge' WHEN shipping_condition IN ('20', '21') THEN 'Rail' WHEN shipping_condition IN ('10', '11') THEN 'Truck'
       WHEN shipping_condition = '80' THEN 'ITT' ELSE '' END AS mot,
  coalesce(load_id, load_id_a) AS load_id, replace(coalesce(license_plate, license_plate_a), chr(65533), '') AS license_plate, coalesce(driver_text, driver_text_a) AS driver_text,
  CASE WHEN purchase_order_type IN ('TTTM', 'TTTS', 'TTTT', 'TTTI') OR month(valid_from) = 6 THEN contract_start_period WHEN month(valid_to) = 6 THEN contract_end_period
       ELSE contract_start_period END AS abholzeitraum, NULL AS billing_document, NULL AS invoice_type_name, '1998-06-15 09:30:00' AS write_timestamp
FROM shared s LEFT JOIN material_mapping m ON m.material_number = s.material_number
LEFT JOIN (SELECT DISTINCT * FROM backfill_extract) x ON material_document_number_a = material_document_number AND material_number_a = s.material_number AND contract_number = contract_no
WHERE s.material_number <> '17'
UNION ALL BY NAME
SELECT DISTINCT 'invoice_delivery' AS output, CAST(billing_date AS VARCHAR) AS billing_date, delivery_number, billing_document, invoice_type_name, '1998-06-15 09:30:00' AS write_timestamp
FROM (SELECT invoice_type, billing_date, ltrim(delivery_number, '0') AS delivery_number, si, first(invoice_number ORDER BY invoice_number ASC NULLS FIRST) AS billing_document FROM shared GROUP BY 1, 2, 3, 4)
JOIN invoice_type_mapping ON gsap_code = invoice_type""").replace("\n, shared", "\n, shared", 1))
def job_delivery_mapping(t):
    """Both outputs, told apart by ``output``."""
    made = _written(t, lambda: delivery_mapping.run(t.spark, _with_plan(t), AS_OF, replace(MAPPING, excluded_materials=("17",))), "delivery_mapping", "invoice_delivery")
    rows = made["delivery_mapping"].drop("ca_last_mdf", "created_date_time").distinct()
    both = rows.withColumn("output", F.lit("delivery_mapping")).unionByName(
        made["invoice_delivery"].withColumn("output", F.lit("invoice_delivery")), allowMissingColumns=True)
    return rounded(both)


# ---- history, ingest ----


def _stored(t, **frames) -> Catalog:
    """The frames as stored tables below the scratch folder."""
    catalog = Catalog()
    for name, df in frames.items():
        spec = TableSpec("parquet", scratch_path(t.spark, name))
        write_table(df, spec)
        catalog.add(name, spec)
    return catalog


_MERGED = """SELECT o_orderkey, coalesce(new.o_custkey, old.o_custkey) AS o_custkey, coalesce(new.o_orderstatus, old.o_orderstatus) AS o_orderstatus,
  coalesce(new.o_totalprice, old.o_totalprice) AS o_totalprice, coalesce(new.o_orderpriority, old.o_orderpriority) AS o_orderpriority"""


@query("job_history_summary", f"WITH {_VERSIONS} {_MERGED} FROM old FULL JOIN new USING (o_orderkey)")
def job_history_summary(t):
    """The merged rows replace the history table they were read from."""
    old, new = _versions(t)
    catalog = _stored(t, contract_summary=new, summary_history=old)
    merged = history.run_summary(t.spark, catalog, keys=["o_orderkey"])["merged"]
    history.store(merged, catalog, "summary_history")
    return read_table(t.spark, catalog, "summary_history")


_THREE = "o_orderkey, o_custkey, o_orderstatus"


@query("job_history_mapping", f"""WITH {_VERSIONS}
SELECT {_THREE}, coalesce(new.o_totalprice, old.o_totalprice) AS o_totalprice, coalesce(new.o_orderpriority, old.o_orderpriority) AS o_orderpriority
FROM old RIGHT JOIN new USING ({_THREE})""")
def job_history_mapping(t):
    old, new = _versions(t)
    catalog = _stored(t, delivery_mapping=new, mapping_history=old)
    merged = history.run_mapping(t.spark, catalog, keys=["o_orderkey", "o_custkey", "o_orderstatus"])["merged"]
    history.store(merged, catalog, "mapping_history")
    return read_table(t.spark, catalog, "mapping_history")


@query("job_history_mapping_kept", f"""WITH {_VERSIONS}
SELECT {', '.join(f'coalesce(new.{c}, old.{c}) AS {c}' for c in _THREE.split(', '))},
  coalesce(new.o_totalprice, old.o_totalprice) AS o_totalprice, coalesce(new.o_orderpriority, old.o_orderpriority) AS o_orderpriority
FROM old FULL JOIN new USING ({_THREE})""")
def job_history_mapping_kept(t):
    """The same on three keys, with the rows that only the history has."""
    old, new = _versions(t)
    catalog = _stored(t, delivery_mapping=new, mapping_history=old)
    merged = history.run_mapping(t.spark, catalog, keys=_THREE.split(", "), keep_history=True)["merged"]
    history.store(merged, catalog, "mapping_history")
    return read_table(t.spark, catalog, "mapping_history")


_SLICED = "o_orderkey % 16"


@query("job_history_touched", f"""WITH {_VERSIONS},
part AS (SELECT * FROM new WHERE {_SLICED} < 5)
{_MERGED.replace('new.', 'part.')}, ({_SLICED})::BIGINT AS slice FROM old FULL JOIN part USING (o_orderkey)""")
def job_history_touched(t):
    """Five of sixteen slices have new rows; the history's other slices stay where they lie."""
    old, new = (df.withColumn("slice", F.expr(_SLICED)) for df in _versions(t))
    catalog = Catalog()
    for name, df in (("contract_summary", new.where("slice < 5")), ("summary_history", old)):
        spec = TableSpec("parquet", scratch_path(t.spark, name))
        write_table(df, spec, partition_by=["slice"])
        catalog.add(name, spec)
    history.merge_touched(t.spark, catalog, "contract_summary", "summary_history", ["o_orderkey", "slice"], ["slice"], unique_keys=True)
    return read_table(t.spark, catalog, "summary_history")


@query("job_output_counts", """
SELECT 'open' AS output, count(*) AS n_rows FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'other', count(*) FROM orders WHERE o_orderstatus <> 'O'""")
def job_output_counts(t):
    """Rows of each output of a job, counted while they are written."""
    specs = {n: TableSpec("parquet", scratch_path(t.spark, f"counted-{n}")) for n in ("open", "other")}
    rows = write_outputs(t.spark, lambda: {"open": t.orders.where("o_orderstatus = 'O'"), "other": t.orders.where("o_orderstatus <> 'O'")}, specs)
    return t.spark.createDataFrame(sorted(rows.items()), "output string, n_rows long")


@query("job_raw_to_curated", "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def job_raw_to_curated(t):
    return ingest.raw_to_curated(t.spark, t.catalog, "customer", TableSpec("parquet", scratch_path(t.spark, "curated")))


@query("job_mapping_sheet_load", """
SELECT p_partkey AS material_number, p_name AS produkt, p_brand AS subgrade, p_type AS base_grade, p_size::BIGINT AS p_size, p_retailprice FROM part""")
def job_mapping_sheet_load(t):
    sheet = TableSpec("csv", scratch_path(t.spark, "sheet"), PART_SCHEMA)
    write_table(t.part, sheet)
    return ingest.mapping_sheet_load(
        t.spark, Catalog({"sheet": sheet}), "sheet", TableSpec("parquet", scratch_path(t.spark, "material-mapping")),
        rename={"p_partkey": "material_number", "p_name": "produkt", "p_brand": "subgrade", "p_type": "base_grade"})


@query("job_price_audit_collate", """
SELECT DISTINCT c_custkey, c_name, n_name, o_orderstatus, o_orderpriority
FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN orders ON o_custkey = c_custkey""")
def job_price_audit_collate(t):
    """Customers with a nation row, their orders, distinct."""
    base = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("c_custkey").alias("mrc_a"), "n_name")
    prices = t.customer.select("c_custkey", "c_name")
    deals = t.orders.select(F.col("o_custkey").alias("mrc_d"), "o_orderstatus", "o_orderpriority")
    return ingest.price_audit_collate(base, prices, deals, "mrc_a", "c_custkey", "mrc_d")


# ---- earlier forms ----

_LOOSE = """(SELECT mblnr AS qm, zeile AS qz, min(CASE WHEN msehi = 'KG' THEN -adqnt END) AS lifting_in_kg, min(CASE WHEN msehi = 'L15' THEN -adqnt END) AS lifting_in_l15
 FROM movement_quantity WHERE msehi IN ('KG', 'L15') GROUP BY 1, 2)"""
_PLAIN_MOVES = "oihantyp, kdpos, mblnr, kdauf, ebeln, matnr, bukrs, werks, zeile, zxbldat, zxbudat, bwart, oid_extbol"


def _plain_units(t) -> Catalog:
    """The loose pivot meets line numbers without blanks."""
    rows = t.domain.frame("movement_quantity").withColumn("zeile", F.trim("zeile"))
    return t.domain.bind("movement_quantity", rows)


@query("job_movements_prototype", with_ctes(f"""
SELECT DISTINCT {', '.join(f'm.{c.strip()}' for c in _PLAIN_MOVES.split(','))}, lifting_in_kg, lifting_in_l15, aedat, inco1, inco2
FROM movement m LEFT JOIN {_LOOSE} ON qm = m.mblnr AND trim(qz) = m.zeile
LEFT JOIN (SELECT DISTINCT aedat, ebeln, inco1, inco2 FROM purchase_header) e ON e.ebeln = m.ebeln"""))
def job_movements_prototype(t):
    made = prototypes.run_movements(t.spark, _plain_units(t))["movements"]
    return prototypes.store_in_files(made, TableSpec("parquet", scratch_path(t.spark, "movements-prototype")))


_TERMINAL = with_ctes(f"""
SELECT h.*, n1.name1 AS sold_to_name, n2.name1 AS ship_to_name, kn.kunn2, n3.name1 AS national_account_name, c.bsark_e, p.pricing_scheme, volum, oid_ship, posnr, vbap_werks, umzin,
  f.delivery_number, prod_group_desc, prod_subgroup, grade, plant_name, invoice_number, vbrp_position_number, fkart, zterm, zlsch, billing_date,
  oihantyp, mblnr, ebeln, bukrs, v.werks, zeile, zxbldat, zxbudat, bwart, oid_extbol, mseg_matnr, lifting_in_kg, lifting_in_l15
FROM (SELECT DISTINCT vbeln, guebg, gueen, erdat, erzet, ctlpc, auart, vsbed, vtweg, kunnr, knumv, ktext FROM contract_header) h
LEFT JOIN (SELECT DISTINCT matnr, volum, oid_ship, posnr, vbeln, vbap_werks, umzin FROM contract_item) i ON i.vbeln = h.vbeln
LEFT JOIN (SELECT DISTINCT vbeln AS delivery_number, vbelv FROM document_flow) f ON f.vbelv = h.vbeln
LEFT JOIN (SELECT DISTINCT kunnr, name1 FROM customer_name) n1 ON n1.kunnr = h.kunnr
LEFT JOIN (SELECT DISTINCT kunnr, name1 FROM customer_name) n2 ON n2.kunnr = oid_ship
LEFT JOIN (SELECT DISTINCT kunn2, kunnr FROM customer_partner) kn ON kn.kunnr = h.kunnr
LEFT JOIN (SELECT DISTINCT kunnr, name1 FROM customer_name) n3 ON n3.kunnr = kn.kunn2
LEFT JOIN (SELECT DISTINCT bsark_e, vbeln FROM contract_commercial_head) c ON c.vbeln = h.vbeln
LEFT JOIN (SELECT DISTINCT knumv, CASE kschl WHEN 'YP03' THEN 'TERM' WHEN 'YP10' THEN 'TERMMAN' ELSE 'SPOT' END AS pricing_scheme
           FROM price_condition_head WHERE kschl <> 'XX01') p ON p.knumv = h.knumv
LEFT JOIN (SELECT DISTINCT prod_group_desc, matnr, prod_subgroup, grade FROM material_master) m ON m.matnr = ltrim(i.matnr, '0')
LEFT JOIN sites ON sites.werks = vbap_werks
LEFT JOIN (SELECT DISTINCT vbeln AS invoice_number, posnr AS vbrp_position_number, aubel FROM billing_item) b ON b.aubel = h.vbeln
LEFT JOIN (SELECT DISTINCT vbeln, fkart, zterm, zlsch, erdat AS billing_date FROM billing_header) bh ON bh.vbeln = invoice_number
JOIN (SELECT DISTINCT {_PLAIN_MOVES.replace('matnr', 'matnr AS mseg_matnr')} FROM movement) v ON v.kdauf = 'S' || substr(h.vbeln, 2) AND v.kdpos = posnr
LEFT JOIN {_LOOSE} ON qm = v.mblnr AND trim(qz) = v.zeile""")
_TERMINAL_DISTINCT = "SELECT DISTINCT h.*, n1"


@query("job_terminal_prototype", _TERMINAL.replace("\nSELECT h.*, n1", f"\n{_TERMINAL_DISTINCT}"))
def job_terminal_prototype(t):
    """Movements of the derived tables name the sales order; here they name the contract."""
    catalog = _plain_units(t)
    for name in ("contract_commercial", "price_condition"):
        catalog.bind(name, catalog.frame(f"{name}_head"))
    moved = catalog.frame("movement").withColumn("kdauf", F.concat(F.lit("0"), F.substring("kdauf", 2, 15)))
    with staging(t.spark):
        made = prototypes.run_terminal(t.spark, catalog.bind("movement", moved, catalog.unique("movement")), sliced=True)["contract_movements"]
        return prototypes.store_in_files(made, TableSpec("parquet", scratch_path(t.spark, "terminal-prototype")))


@query("job_sales_contract_legacy", with_ctes(f"""
, legacy_heads AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vbeln, erdat, erzet, ctlpc, auart, vsbed, vtweg, oid_miscdl, kunnr, knumv
    ORDER BY batch_time DESC, gueen DESC, guebg DESC, ktext ASC NULLS FIRST) AS rn FROM contract_header
  WHERE vtweg = '02' AND auart IN ('ZCQ', 'ZCRM') AND vkorg IN ('DE01', 'AT01')) WHERE rn = 1 AND gueen BETWEEN '19980307' AND '19990131')
SELECT * REPLACE (CASE WHEN bsark_e <> '' THEN bsark_e WHEN auart = 'ZCRM' THEN 'TRRM' WHEN pricing_scheme IN ('SPOT', 'TERMMAN') THEN 'TSFP' ELSE 'TTFD' END AS bsark_e) FROM (
SELECT h.vbeln, h.guebg, h.gueen, h.erdat, h.erzet, h.ctlpc, h.auart, h.vsbed, h.vtweg, h.kunnr, h.knumv, coalesce(h.ktext, '') AS ktext,
  i.matnr, i.oid_ship, i.posnr, i.vbap_werks, i.abgru, i.zmeng, i.zieme, i.bukrs AS vbap_bukrs, f.mseg_so, l.* EXCLUDE (kdauf, kdpos, mseg_matnr, ca_last_mdf),
  n1.name1 AS sold_to_name, n2.name1 AS ship_to_name, c.bsark_e, invoice_number, vbrp_position_number, fkart, zterm, zlsch, billing_date, pricing_scheme,
  prod_group_desc, prod_subgroup, grade, plant_name
FROM legacy_heads h
LEFT JOIN (SELECT DISTINCT matnr, oid_ship, posnr, vbeln, vbap_werks, abgru, zmeng, zieme, bukrs FROM contract_item) i ON i.vbeln = h.vbeln
LEFT JOIN (SELECT DISTINCT vbeln AS mseg_so, vbelv FROM document_flow) f ON f.vbelv = h.vbeln
LEFT JOIN lifted l ON l.kdauf = f.mseg_so AND l.kdpos = i.posnr
LEFT JOIN (SELECT DISTINCT kunnr, name1 FROM customer_name WHERE name1 <> '') n1 ON n1.kunnr = h.kunnr
LEFT JOIN (SELECT DISTINCT kunnr, name1 FROM customer_name) n2 ON n2.kunnr = oid_ship
LEFT JOIN (SELECT DISTINCT bsark_e, vbeln FROM contract_commercial WHERE bsark_e <> '') c ON c.vbeln = h.vbeln
LEFT JOIN (SELECT DISTINCT vbeln AS invoice_number, posnr AS vbrp_position_number, aubel FROM billing_item) b ON b.aubel = f.mseg_so
LEFT JOIN (SELECT DISTINCT vbeln, fkart, zterm, zlsch, erdat AS billing_date FROM billing_header) bh ON bh.vbeln = invoice_number
LEFT JOIN (SELECT DISTINCT knumv, kposn, pricing_scheme FROM prices) p ON p.knumv = h.knumv AND p.kposn = i.posnr
LEFT JOIN (SELECT DISTINCT prod_group_desc, matnr, prod_subgroup, grade FROM material_master) m ON m.matnr = ltrim(i.matnr, '0')
LEFT JOIN sites ON sites.werks = vbap_werks) WHERE coalesce(trim(abgru), '') = ''"""))
def job_sales_contract_legacy(t):
    """Movements come from a stored table, as written by the movement job."""
    t.items  # written before the block, whose frames go  # noqa: B018
    with staging(t.spark):
        catalog = _stored(t, stored_movements=movements.run(t.spark, t.domain, AS_OF, MOVEMENT, staged=True)["movements"])
    t.domain.add("stored_movements", catalog.spec("stored_movements"))
    return prototypes.run_legacy(t.spark, t.domain, AS_OF, replace(prototypes.LEGACY_WINDOW, movement=MOVEMENT))["contract_movements"].drop("ca_last_mdf")
