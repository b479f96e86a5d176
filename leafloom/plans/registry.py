"""All queries of the document-structuring operators with their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "f06_review_queue"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


for _family in ("text", "relational", "ordered", "search_qa", "audit", "layout", "assembly", "io"):
    importlib.import_module(f"leafloom.plans.{_family}_queries")
