"""All registered queries; importing the modules fills the registry."""

from liftplan.suite import filters, functions, grouping, jobs, joins, rules, scans  # noqa: F401
from liftplan.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
