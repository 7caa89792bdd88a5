"""Queries over the reference's operators. Importing the modules registers them."""

from __future__ import annotations

from corpusloom.queries import events_queries, flow_queries, inline_queries, more_queries, report_queries, row_queries, state_queries  # noqa: F401
from corpusloom.queries.sql_forms import FORMS
from corpusloom.registry import QUERIES, SQL, Query
from corpusloom.shipping import shipped


def queries() -> dict[str, Query]:
    return {name: shipped(f) for name, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return SQL | FORMS
