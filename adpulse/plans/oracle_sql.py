"""DuckDB text helpers mirroring column expressions of the library."""

from __future__ import annotations


def duck_day(ms: str) -> str:
    """UTC ``yyyy-MM-dd`` of epoch milliseconds (non-negative)."""
    return f"CAST(DATE '1970-01-01' + CAST(({ms}) // 86400000 AS INTEGER) AS VARCHAR)"


def duck_hour(ms: str) -> str:
    return f"lpad(CAST((({ms}) % 86400000) // 3600000 AS VARCHAR), 2, '0')"


def counter(code: int, field: str) -> str:
    return f"CASE WHEN type = {code} OR {field} > 0 THEN coalesce({field}, 1) ELSE 0 END"


def price(code: int, field: str) -> str:
    return f"CASE WHEN type = {code} OR {field} > 0 THEN coalesce({field}, price, 0) ELSE 0 END"


def date_str(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"
