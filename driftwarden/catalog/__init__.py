"""Runnable queries over the given tables, each with the SQL that has to agree."""

from __future__ import annotations

import importlib

from driftwarden.catalog.registry import ORACLE, QUERIES

for _name in (
    "performance",
    "profiling",
    "drift",
    "explaining",
    "joining",
    "ordering",
    "splitting",
    "columns",
    "text",
    "encoding",
    "connectors",
    "modelling",
    "governance",
    "periods",
):
    importlib.import_module(f"driftwarden.catalog.{_name}")

__all__ = ["ORACLE", "QUERIES"]
