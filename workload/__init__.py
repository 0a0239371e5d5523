"""Bindings of the library's operators to the supplied tables, each with its SQL twin."""

from .catalog import ORACLES, QUERIES
from . import delivery_queries, evidence_queries, file_queries, ledger_queries, mart_queries, table_queries  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
