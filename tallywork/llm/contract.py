"""The registered queries of this subpackage, and the pipeline at the top of the repository."""

from __future__ import annotations

from tallywork.llm import queries  # noqa: F401  (imported for its registrations)
from tallywork.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
