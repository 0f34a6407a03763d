"""Truth tables of the business rules."""

import datetime as dt

import pytest

from liftplan.rules import movements, order_types, parties, periods, plan_rules, quantities

AS_OF = "2022-10-15"


def table(spark, schema, *rows):
    return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)


def column(df, name):
    return [r[name] for r in df.collect()]


def test_deal_type_drops_unknown_codes(spark):
    df = order_types.deal_type(table(spark, "kschl string", "YP03", "YP04", "YP09", "YP10", "YP23", "YP24", "XX", None))
    assert column(df, "pricing_scheme") == ["TERM", "TERM", "TERMMAN", "TERMMAN", "SPOT", "SPOT"]


@pytest.mark.parametrize("gone", [None, ""])
def test_order_type_default(spark, gone):
    df = table(spark, "bsark_e string, auart string, pricing_scheme string",
               (gone, "ZCRM", "TERM"), (gone, "ZCQ", "TERM"), (gone, "ZCQ", "SPOT"), (gone, "ZCQ", "TERMMAN"),
               (gone, "ZCQ", None), (gone, None, "SPOT"), ("TTTT", "ZCRM", "SPOT"))
    assert column(order_types.order_type_default(df), "bsark_e") == ["TRRM", "TTFD", "TSFP", "TSFP", "TTFD", gone, "TTTT"]


def test_overlift_needs_all_conditions(spark):
    schema = "purchase_order_type string, shipping_condition_tbu string, pricing_scheme string, creation_date string, valid_to string"
    df = table(spark, schema,
               ("TTFD", "10", "TERMMAN", "20220101", "20220101"), ("TTTT", "10", "TERMMAN", "20220102", "20220101"),
               ("TTFD", "10", "TERMMAN", "20211231", "20220101"), ("TTFD", "11", "TERMMAN", "20220102", "20220101"),
               ("TTFD", "10", "TERM", "20220102", "20220101"), ("TSFP", "10", "TERMMAN", "20220102", "20220101"))
    assert column(order_types.overlift_class(df), "purchase_order_type") == [
        "TOL_TERM", "TOL_TRIGGER", "TTFD", "TTFD", "TTFD", "TSFP"]


def test_pricing_bucket_and_split(spark):
    rows = [(p, d, 6.0) for p in ("Half-Month", "Decade", "Monthly", None)
            for d in ("20220101", "20220111", "20220116", "20220120", None)]
    df = table(spark, "pricing_period string, valid_from string, plan_m3 double", *rows)
    assert column(plan_rules.pricing_bucket(df), "pricing_period") == [
        "H1", "Half-Month", "H2", "Half-Month", "Half-Month", "D1", "D2", "D3", "D3", "D3", *["Monthly"] * 5, *[None] * 5]
    assert column(plan_rules.plan_split(df), "plan_m3") == [3.0] * 5 + [2.0] * 5 + [6.0] * 10


def test_shipping_term_labels(spark):
    rows = [(m, i) for m in ("ITT", "Barge", "Rail", "Truck", None) for i in ("FOB", "FCA", None)]
    df = plan_rules.shipping_term(table(spark, "mot string, incoterm string", *rows))
    road = "Road Delivery"
    assert column(df, "shipping_condition_term") == [
        "In-Tank", "In-Tank", "In-Tank", "Vessel Pickup", "Vessel Delivery", road,
        "Rail Delivery", "Rail Pickup", road, road, "Road Pickup", road, road, road, road]


def test_target_units_by_unit_and_grade(spark):
    rows = [(1000.0, u, g) for u in ("L15", "TO", "M15", None) for g in ("Mogas", "GtL", "AGO", None)]
    got = [(r.target_qty_to, r.target_qty_m3) for r in quantities.target_units(
        table(spark, "avg_target_quantity double, uom string, grade string", *rows)).collect()]
    q, none = 1000.0, (None, None)
    assert got == [(q, 1.0)] * 4 + [(q, q / 0.755), (q, q / 0.779), (q, q / 0.845), none] + [
        (q * 0.755, q), (q * 0.779, q), (q * 0.845, q), none] + [none] * 4


def test_tolerance_steps(spark):
    df = table(spark, "purchase_order_type string, avg_target_quantity double, target_qty_m3 double",
               *[("TSFP", q, 1.0) for q in (0.0, 100.0, 101.0, 300.0, 301.0, None)],
               ("TRRM", 50.0, 10.0), ("TTFD", 50.0, 10.0), (None, 50.0, 10.0))
    assert column(quantities.tolerance(df), "tolerance_m15") == [5, 5, 10, 10, 15, None, 0, 0.5, None]


def test_planned_quantity(spark):
    schema = "purchase_order_type string, target_qty_m3 double, volume_cbm double, avg_plan_m3 double"
    df = table(spark, schema, ("TRRM", 10.0, 20.0, 30.0), ("TSFP", 10.0, 20.0, 30.0), ("TTFD", 10.0, 20.0, 30.0),
               (None, 10.0, 20.0, 30.0), ("TTFD", 10.0, 20.0, 2.99), ("TTFD", 10.0, 20.0, 3.0), ("TTFD", 1.0, 1.0, None))
    assert column(quantities.planned_quantity(df), "fullcalc_phil") == [10, 20, 30, 0.001, 2.99 / 1000, 3, 0.001]


def test_backup_prune_keeps_null_plan(spark):
    df = table(spark, "id int, sum_lifting_in_cbm double, depot_property string, avg_plan_m3 double",
               (1, 0.0, "back-up", 4.99), (2, 0.0, " back-up ", 4.99), (3, 0.0, "back-up", 5.0),
               (4, 0.0, "back-up", None), (5, 1.0, "back-up", 1.0), (6, 0.0, None, 1.0))
    assert column(quantities.backup_prune(df), "id") == [3, 4, 5, 6]


def test_fulfilment_ratios(spark):
    df = table(spark, "sum_fullcalc_phil double, sum_sum_lifting_in_cbm double, sum_lifting_in_cbm double, avg_plan_m3 double, fullcalc_phil double, avg_target_quantity double",
               (0.9, 1.0, 0.0, 1.0, 1.0, 4.0), (0.91, 0.91, 2.0, 4.99, 1.0, 4.0), (0.0, 1.0, 2.0, 5.0, 0.0, 0.0), (None, 1.0, 2.0, None, 8.0, 4.0))
    assert column(quantities.fulfil_percent(df), "erfüllung") == [None, 100.0, None, None]
    assert column(quantities.fulfil_vs_plan(df), "fullfillment_vs_plan") == [0.0, None, None, 0.25]
    assert column(quantities.fulfil_vs_target(df), "fullfillment_vs_target") == [0.0, 0.5, None, 0.5]


def test_product_label(spark):
    df = quantities.product_label(table(spark, "grade string, subgrade string", ("ago", "s"), ("IGO", "s"), ("Mogas", "s"),
                                        ("GtL Plus", "s"), ("FSD", "s"), ("LNG", "s"), ("X", "s"), (None, "s")))
    assert column(df, "produkt") == ["Diesel", "Heizöl", "Benzin", "s", "Fuel Save Diesel", "LNG", "Other", "Other"]


@pytest.mark.parametrize("as_of, second", [("2022-10-15", "end"), ("2023-01-03", "start")])
def test_pickup_period(spark, as_of, second):
    d = dt.date
    schema = "valid_from date, valid_to date, purchase_order_type string, contract_start_period string, contract_end_period string"
    df = table(spark, schema, (d(2022, 10, 1), d(2022, 12, 1), "TTFD", "start", "end"), (d(2022, 5, 1), d(2022, 10, 9), "TTFD", "start", "end"),
               (d(2022, 10, 1), d(2022, 10, 9), "TTFD", "start", "end"), (d(2022, 5, 1), d(2022, 10, 9), "TTTT", "start", "end"), (None, None, None, "start", "end"))
    assert column(periods.pickup_period(df, as_of), "abholzeitraum") == ["start", second, "start", "start", "start"]


def test_active_and_days_left(spark):
    df = table(spark, "valid_from date, valid_to date", (dt.date(2022, 10, 15), dt.date(2022, 10, 15)),
               (dt.date(2022, 10, 16), dt.date(2022, 10, 20)), (None, dt.date(2022, 10, 1)))
    got = periods.days_left(periods.active_flag(df, AS_OF), AS_OF)
    assert column(got, "active") == ["Active", "Inactive", "Inactive"]
    assert column(got, "laufzeit") == [0, 5, -14]


def test_reversals(spark):
    df = table(spark, "bwart string, lifting_in_kg double, posnr string, vbfa_posnv string",
               ("602", 5.0, "a", "b"), ("601", 5.0, "a", "b"), (None, 5.0, "a", "b"), ("102", None, "a", None))
    assert column(movements.reversal_sign(df, measures=["lifting_in_kg"]), "lifting_in_kg") == [-5, 5, 5, None]
    assert column(movements.reversal_redirect(df, redirect={"posnr": "vbfa_posnv"}), "posnr") == ["b", "a", "a", None]


def test_rejected_removal(spark):
    df = table(spark, "id int, abgru string", (1, None), (2, ""), (3, "   "), (4, "X"))
    assert column(movements.rejected_removal(df), "id") == [1, 2, 3]


def test_trigger_plan_on_two_modes(spark):
    schema = """contract_start_period string, ship_to_number string, plant_code string, material_number string, mot string, pricing_period string,
                purchase_order_type string, contract_no string, avg_plan_m3 double, avg_plan_to double"""
    k = ("2022-10", "s", "p", "m")
    df = table(spark, schema, (*k, "Barge", "Trigger", "TTTT", "1", 8.0, 4.0), (*k, "Barge", "Trigger", "TTTT", "2", 4.0, 2.0),
               (*k, None, "Trigger", "TTTS", None, 4.0, 2.0), (*k, "Truck", "Monthly", "TTFD", "3", 1.0, 1.0))
    got = plan_rules.trigger_plan(df)
    assert sorted(column(got, "trigger_contract_num_plan"), key=str) == [3.0, 3.0, None, None]
    # Without the mode in the key, rows meet the plans of both modes.
    assert plan_rules.trigger_plan(df, match_mode=False).count() == 8


def test_trigger_override(spark):
    df = table(spark, "pricing_period string, mot string, avg_plan_m3 double, avg_plan_to double, trigger_contract_num_plan double, trigger_contract_num_plan_to double",
               ("Trigger", "Truck", 1.0, 1.0, 5.0, 6.0), ("Monthly", "Rail", 1.0, 1.0, 5.0, 6.0), ("Monthly", "Truck", 1.0, 1.0, 5.0, 6.0), (None, None, 1.0, 1.0, 5.0, 6.0))
    assert column(plan_rules.trigger_override(df), "avg_plan_m3") == [5, 5, 1, 1]


def test_sales_group_fallback(spark):
    rows = table(spark, "ship_to_number string, sold_to_number string", ("1", "2"), ("3", "1"), ("9", None))
    area = table(spark, "kunnr string, vkorg string, vkgrp string", ("0001", "DE01", "B"), ("0001", "DE01", "A"), ("0002", "XX", "Z"), ("0003", "DE01", None))
    sheet = table(spark, "partner string, partner_sales_group string", ("0002", "M2"), ("0003", "M3"), ("0001", "M1"))
    got = {(r.ship_to_number, r.sold_to_number): (r.si, r.kam) for r in parties.sales_group(rows, area, sheet).collect()}
    assert got == {("1", "2"): ("A", "M2"), ("3", "1"): ("M3", "A"), ("9", None): (None, None)}
