"""Query catalogue: bindings, composed flows and the registered queries."""

from . import q_clean, q_features, q_io, q_models, q_serve, q_stats  # noqa: F401  (register queries)
from .catalog import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
