"""All queries of the library, and their SQL."""

from . import queries_data, queries_more, queries_sources, queries_time  # noqa: F401  (they register themselves)
from .catalogue import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
