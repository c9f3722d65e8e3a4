"""All registered queries: importing this module fills the registry."""

from __future__ import annotations

from . import q_clean, q_eda, q_eval, q_features, q_misc, q_models, q_ops, q_sources, q_spatial, q_splits  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
