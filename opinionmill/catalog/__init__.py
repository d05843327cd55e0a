"""Named queries over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from opinionmill.catalog import (  # noqa: F401
    clean, dashboard, evaluation, evidence, features, models, ranked, stages, streams, translation,
)
from opinionmill.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
