"""Importing this module fills the registry."""

from plantmetrics.registry import kpis, learning, tables, texts, versions  # noqa: F401
from plantmetrics.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
