"""Small made-up tables for queries over inputs that the driver's tables lack, and what is expected of them as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    """Queries and their SQL twins under their names."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def register(f):
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return register


def literal(v) -> str:
    """A value as SQL."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (list, tuple)):
        return f"[{', '.join(map(literal, v))}]"
    return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"


def rows_sql(columns: str, rows: list[tuple]) -> str:
    """A SELECT of rows with columns given as "name type, name type"."""
    parts = [c.strip().split(" ", 1) for c in columns.split(",")]
    casts = ", ".join(f"CAST(c{k} AS {kind}) AS {name}" for k, (name, kind) in enumerate(parts))
    values = ", ".join(f"({', '.join(map(literal, r))})" for r in rows)
    return f"SELECT {casts} FROM (VALUES {values}) AS t({', '.join(f'c{k}' for k in range(len(parts)))})"
