"""One DuckDB statement per registered query that SQL can express."""

from __future__ import annotations

from . import marketplace_sql, retail_sql, review_sql, stream_sql


def all_statements() -> dict[str, str]:
    return {**retail_sql.statements(), **marketplace_sql.statements(), **review_sql.statements(), **stream_sql.statements()}
