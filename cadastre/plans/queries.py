"""All registered queries; importing the two modules registers them."""

from cadastre.plans import queries_records, queries_tables  # noqa: F401
from cadastre.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
