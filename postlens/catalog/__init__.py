"""Registered queries over the driver tables, each with the SQL that checks it."""

from __future__ import annotations

from postlens.catalog.registry import ORACLES, QUERIES

from postlens.catalog import models, operators, quality, retrieval, streams, text, web  # noqa: F401, E402

__all__ = ["ORACLES", "QUERIES"]
