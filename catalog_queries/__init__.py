"""Registered queries: Spark form and, where SQL can say it, the same result in DuckDB SQL."""

from catalog_queries import catalog, crawling, extraction, registration, shops, streams, texts  # noqa: F401
from catalog_queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
