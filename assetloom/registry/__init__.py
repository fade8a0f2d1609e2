"""Named queries over the driver tables and the SQL each is checked against."""

from assetloom.registry import (filters, jobs, ledgers, metrics, names, ordering, payloads,  # noqa: F401
                                sources, streams)
from assetloom.registry.base import QUERIES, Query, Tables

__all__ = ["QUERIES", "Query", "Tables"]
