"""Queries of the library over the given tables, with equivalent SQL."""

from __future__ import annotations


def _modules():
    from paperloom.plans.registered import article_queries, evaluation_queries, stored_queries, vector_queries

    return [vector_queries, evaluation_queries, article_queries, stored_queries]


def queries() -> dict:
    return {name: f for module in _modules() for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _modules() for name, sql in module.SQL.items()}
