"""The registered queries, gathered from the modules that define them."""

from __future__ import annotations

from tallywork.plans import (  # noqa: F401  (imported for their registrations)
    files,
    graphs,
    models,
    similar,
    splits,
    streams,
    tables,
    texts,
)
from tallywork.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
