"""All registered queries."""

from __future__ import annotations

from brightloom.plans import queries_features, queries_models, queries_streams, queries_tables

QUERIES: dict = {}
SQL: dict[str, str] = {}

for _module in (queries_tables, queries_features, queries_models, queries_streams):
    QUERIES.update(_module.QUERIES)
    SQL.update(_module.SQL)
