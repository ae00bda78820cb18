from panelwatch.queries.registry import ORACLES, QUERIES
from panelwatch.queries import windows, shapes, scoring, stores, reports  # noqa: F401  (they register themselves)

__all__ = ["ORACLES", "QUERIES"]
