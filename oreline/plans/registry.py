"""All registered queries: name to (query, oracle SQL or None)."""

from __future__ import annotations

from oreline.plans import model_queries, numeric_queries, text_queries, tree_queries
from oreline.plans.tables import rounded_sql

QUERIES = {
    name: (query, sql and rounded_sql(sql))
    for part in (text_queries, numeric_queries, model_queries, tree_queries)
    for name, (query, sql) in part.QUERIES.items()
}
