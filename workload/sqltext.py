"""Shared pieces of the DuckDB checks, one common table expression per binding."""

from __future__ import annotations

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def sql(body: str, *names: str) -> str:
    """A query with the named expressions in front, in the given order."""
    if not names:
        return body.strip()
    parts = ",\n".join(f"{name} AS (\n{CTES[name]}\n)" for name in names)
    return f"WITH {parts}\n{body.strip()}"


def day_series(source: str, column: str, extra: int = 0) -> str:
    return (
        f"SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS delivery_date "
        f"FROM (SELECT min({column}) AS a, max({column}) + {extra} AS b FROM {source})"
    )
