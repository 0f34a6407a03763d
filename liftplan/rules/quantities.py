"""Target, tolerance, planned quantity and fulfilment rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftplan.functions.numbers import safe_div, thousandth
from liftplan.operators.filters import remove_where
from liftplan.operators.joins import lookup
from liftplan.rules import tables as R


def unit_scale(df: DataFrame, kg: str = "lifting_in_kg", l15: str = "lifting_in_l15",
               to: str = "lifting_in_to", cbm: str = "lifting_in_cbm") -> DataFrame:
    """Add tonnes and cubic metres to kilograms and litres."""
    return df.withColumns({to: thousandth(kg), cbm: thousandth(l15)})


def target_units(df: DataFrame, quantity: str = "avg_target_quantity", uom: str = "uom",
                 grade: str = "grade", densities: R.Densities = R.GRADE_DENSITIES) -> DataFrame:
    """Target quantity in tonnes and cubic metres.

    A target in litres keeps its number as tonnes, as in the source reports.
    A null grade gives null unless the target is in litres.
    """
    q, u, d = F.col(quantity), F.col(uom), densities.of(F.col(grade))
    graded = F.col(grade).isNotNull()
    return df.withColumns({
        "target_qty_to": F.when(u == "L15", q).when((u == "TO") & graded, q).when(u != "TO", q * d),
        "target_qty_m3": F.when(u == "L15", thousandth(quantity)).when(u == "TO", q / d)
        .when(u.isNotNull() & graded, q),
    })


def tolerance(df: DataFrame, order_type: str = "purchase_order_type",
              quantity: str = "avg_target_quantity", target_m3: str = "target_qty_m3",
              out: str = "tolerance_m15", rules: R.Tolerance = R.Tolerance()) -> DataFrame:
    """Allowed deviation by order type and size of the target."""
    t, q = F.col(order_type), F.col(quantity)
    steps = F.when(q.isNotNull(), F.lit(rules.rest))
    for above, value in reversed(list(rules.steps)):
        steps = F.when(q > above, F.lit(value)).otherwise(steps)
    return df.withColumn(out, F.when(t == rules.none, q * F.lit(0.0))
                         .when(t == rules.spot, steps)
                         .when(t.isNotNull(), F.col(target_m3) * F.lit(rules.share)))


def audit_volume(df: DataFrame, report: DataFrame, out: str = "volume_cbm",
                 fallback: str = "target_qty_m3") -> DataFrame:
    """Volume from the price audit report, else the target volume.

    ``report`` has contract_no, material_number, plant_code and volume_cbm.
    """
    found = lookup(df, report,
                   on={"contract_no": "contract_no", "material_number": "material_number",
                       "plant_code": "plant_code"},
                   take={out: "volume_cbm"})
    return found.withColumn(out, F.coalesce(F.col(out), F.col(fallback)))


def fulfil_ratio(df: DataFrame, out: str = "erfullt_zu") -> DataFrame:
    """Lifted against target for spot and trigger types, else against plan."""
    t = F.col("purchase_order_type")
    by_target = t.isin(list(R.TARGET_RATIO_TYPES))
    return df.withColumn(out, F.when(by_target, safe_div("sum_lifting_in_cbm", "target_qty_m3"))
                         .when(~by_target, safe_div("sum_lifting_in_cbm", "avg_plan_m3")))


def planned_quantity(df: DataFrame, out: str = "fullcalc_phil", limits: R.Limits = R.Limits()) -> DataFrame:
    """Reference quantity by order type; a missing one counts as 1, small ones are scaled down."""
    t = F.col("purchase_order_type")
    base = F.coalesce(
        F.when(t.isin(list(R.PLANNED_AS_TARGET)), F.col("target_qty_m3"))
        .when(t.isin(list(R.PLANNED_AS_AUDIT)), F.col("volume_cbm"))
        .when(t.isNotNull(), F.col("avg_plan_m3")),
        F.lit(limits.missing_planned))
    return df.withColumn(out, F.when(base < limits.scale_below, base / F.lit(limits.scale)).otherwise(base))


def plan_override_ttt(df: DataFrame) -> DataFrame:
    """Trigger order types with a contract show the plan per contract."""
    t = F.col("purchase_order_type")
    hit = t.startswith("TTT") & (t != "TTTS") & F.col("contract_no").isNotNull()
    return df.withColumn("avg_plan_m3", F.when(hit, F.col("trigger_contract_num_plan"))
                         .otherwise(F.col("avg_plan_m3")))


def start_period_fill(df: DataFrame) -> DataFrame:
    """Rows without contract start take the plan period."""
    return df.withColumn("contract_start_period", F.coalesce("contract_start_period", "term_plan_period"))


def backup_prune(df: DataFrame, limits: R.Limits = R.Limits()) -> DataFrame:
    """Drop back-up depots with nothing lifted and next to no plan."""
    return remove_where(df, (F.col("sum_lifting_in_cbm") == 0)
                        & (F.trim("depot_property") == R.BACKUP_DEPOT)
                        & (F.col("avg_plan_m3") < limits.small_plan))


def open_quantity(df: DataFrame, planned: str = "fullcalc_phil", lifted: str = "sum_lifting_in_cbm",
                  out: str = "open_qty_m3") -> DataFrame:
    """What is planned and not yet lifted."""
    return df.withColumn(out, F.col(planned) - F.col(lifted))


def contract_split(df: DataFrame, contract: str = "contract_no") -> tuple[DataFrame, DataFrame]:
    """Rows with a contract, and distinct plan-only rows."""
    return df.where(F.col(contract).isNotNull()), df.where(F.col(contract).isNull()).distinct()


def customer_halving(df: DataFrame, ship_tos: Sequence[str], other_plants: Sequence[str],
                     measures: Sequence[str] = ("avg_plan_m3", "avg_plan_to", "fullcalc_phil")) -> DataFrame:
    """Listed customers count half, except at the listed plants."""
    if not ship_tos:
        return df
    hit = F.col("ship_to_number").isin(list(ship_tos)) & ~F.col("plant_code").isin(list(other_plants))
    return df.withColumns({m: F.when(hit, F.col(m) / F.lit(2)).otherwise(F.col(m)) for m in measures})


def fulfil_percent(df: DataFrame, planned: str = "sum_fullcalc_phil", lifted: str = "sum_sum_lifting_in_cbm",
                   out: str = "erfüllung", limits: R.Limits = R.Limits()) -> DataFrame:
    """Per cent lifted of planned; null for a negligible plan."""
    return df.withColumn(out, F.when(F.col(planned) > limits.min_total_planned,
                                     safe_div(lifted, planned) * F.lit(100)))


def fulfil_vs_plan(df: DataFrame, out: str = "fullfillment_vs_plan", limits: R.Limits = R.Limits()) -> DataFrame:
    """0 with nothing lifted, null for a small plan, else lifted by planned."""
    lifted = F.col("sum_lifting_in_cbm")
    return df.withColumn(out, F.when(lifted == 0, F.lit(0.0))
                         .when(F.col("avg_plan_m3") < limits.small_plan, F.lit(None).cast("double"))
                         .otherwise(safe_div(lifted, "fullcalc_phil")))


def fulfil_vs_target(df: DataFrame, out: str = "fullfillment_vs_target") -> DataFrame:
    return df.withColumn(out, safe_div("sum_lifting_in_cbm", "avg_target_quantity"))


def product_label(df: DataFrame, grade: str = "grade", subgrade: str = "subgrade",
                  out: str = "produkt") -> DataFrame:
    """German product label of a grade."""
    g = F.upper(grade)
    label = F.when(g.contains("GTL"), F.col(subgrade))
    for code, text in R.PRODUCT_LABELS.items():
        label = label.when(g == code, text)
    return df.withColumn(out, label.otherwise("Other"))
