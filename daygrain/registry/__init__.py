"""All registered queries: importing this package fills `QUERIES` and `ORACLES`."""

from daygrain.registry import shared_sql  # noqa: F401  (defines what the texts below refer to)
from daygrain.registry import (  # noqa: F401
    golden,
    invariants,
    merging,
    profiling,
    quality,
    reconciling,
    reports,
    runs,
    scalars,
    zones,
)
from daygrain.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
