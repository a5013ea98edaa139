"""The registered queries of the engine and the SQL each should agree with."""

from swathline.plans import inspections, places, records  # noqa: F401  they register their queries
from swathline.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
