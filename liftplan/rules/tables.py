"""Rule values. All of these are fixed values that results depend on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Organisation, channel, document and movement codes.
SALES_ORGS = ("DE01", "AT01")
CHANNELS = ("02",)
RETURN_DOC = "ZCRM"
DOC_TYPES = ("ZCQ", "ZCRM")
MOVEMENT_TYPES = ("101", "102", "601", "602", "301", "302")
REVERSAL_TYPES = ("102", "602", "302")
UNITS = ("KG", "L15")

# Price condition code to deal type.
DEAL_TYPES = {
    "TERM": ("YP03", "YP04"),
    "TERMMAN": ("YP09", "YP10"),
    "SPOT": ("YP23", "YP24"),
}

# Shipping condition code to transport mode.
TRANSPORT_MODES = {
    "Barge": ("30", "31", "40", "41"),
    "Rail": ("20", "21"),
    "Truck": ("10", "11"),
    "ITT": ("80",),
}
BULK_MODES = ("ITT", "Barge", "Rail")

# Order type codes.
OVERLIFT_TYPES = {"TTFD": "TOL_TERM", "TTTT": "TOL_TRIGGER"}
OVERLIFT_SHIPPING = "10"
OVERLIFT_SCHEME = "TERMMAN"
TRIGGER_TYPES = ("TTTM", "TTTS", "TTTT", "TTTI")
PERIOD_TYPES = ("TTFD", "TTTT", "TTTS", "TTTM", "TTTI")
SPOT_TYPES = ("TSFP", "TRRM", "TOL")
TARGET_RATIO_TYPES = ("TSFP", "TTTT", "TRRM", "TOL", "TTTS")
PLANNED_AS_TARGET = ("TRRM", "TOL_TERM", "TOL_TRIGGER")
PLANNED_AS_AUDIT = ("TSFP", "TTTT", "TTTS", "TTTM", "TTTI")

# Pricing periods, first days of their parts, and part counts.
TRIGGER = "Trigger"
PRICING_PARTS = {"Half-Month": 2, "Decade": 3}
HALF_MONTH_DAYS = {1: "H1", 16: "H2"}
DECADE_DAYS = {1: "D1", 11: "D2"}
DECADE_REST = "D3"

# Upper-case grade to product label; a sub-grade replaces GTL.
PRODUCT_LABELS = {
    "AGO": "Diesel",
    "IGO": "Heizöl",
    "MOGAS": "Benzin",
    "FSD": "Fuel Save Diesel",
    "LNG": "LNG",
}

BACKUP_DEPOT = "back-up"


@dataclass(frozen=True)
class Densities:
    """Tonnes per cubic metre by grade."""

    by_grade: Mapping[str, float]
    other: float

    def of(self, grade: Column) -> Column:
        """Density of a grade; null for a null grade."""
        value = F.when(grade.isNotNull(), F.lit(self.other))
        for name, density in reversed(list(self.by_grade.items())):
            value = F.when(grade == name, F.lit(density)).otherwise(value)
        return value


# Grade densities.
GRADE_DENSITIES = Densities({"Mogas": 0.755, "GtL": 0.779}, 0.845)


@dataclass(frozen=True)
class Tolerance:
    """Allowed deviation: fixed steps for spot, a share of target otherwise."""

    steps: Sequence[tuple[float, float]] = ((300.0, 15.0), (100.0, 10.0))
    rest: float = 5.0
    share: float = 0.05
    spot: str = "TSFP"
    none: str = "TRRM"


@dataclass(frozen=True)
class Limits:
    """Cut-off values of the fulfilment rules."""

    small_plan: float = 5.0
    min_total_planned: float = 0.9
    scale_below: float = 3.0
    scale: float = 1000.0
    missing_planned: float = 1.0


def label_by(code: Column, groups: Mapping[str, Sequence[str]], default: str | None) -> Column:
    """Label of the group that lists the code."""
    out = None
    for label, codes in groups.items():
        test = code.isin(list(codes))
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(F.lit(default))
