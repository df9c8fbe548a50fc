"""Imports every query module so the registry is complete."""

from labelgraph.plans import q_files, q_graph, q_ontology, q_predictions, q_prep, q_samples, q_udf  # noqa: F401
from labelgraph.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
