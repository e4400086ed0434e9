"""End-to-end layer compositions over the driver tables, one module per source job family.

Importing this package registers every query key in ``registry.QUERIES`` and its
DuckDB oracle (where one exists) in ``registry.ORACLES``.
"""

from strata.plans import (  # noqa: F401
    api, curriculum, logs, medallion, olympics, playlist, rentals, sales, star, streams, warehouse,
)
from strata.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
