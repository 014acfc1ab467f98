"""All registered queries; importing a module registers its queries."""

from forecastops.plans import bitemporal_queries, control_queries, feature_queries, learning_queries, monitoring_queries, operations_queries, segment_queries, sketch_queries, storage_queries  # noqa: F401
from forecastops.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
