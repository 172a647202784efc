"""All queries over the reference tables, with the SQL they are held against."""

from __future__ import annotations

from . import audit_queries, file_queries, run_queries, text_queries  # noqa: F401  they register themselves
from .registry import query


def queries():
    return dict(query.queries)


def oracle_sql():
    return dict(query.sql)
