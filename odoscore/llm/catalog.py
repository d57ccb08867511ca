"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from . import queries
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES", "queries"]
