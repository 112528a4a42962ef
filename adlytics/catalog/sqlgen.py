"""Small helpers that write the DuckDB oracle SQL for melted (long) aggregates."""

from __future__ import annotations


def q(name: str) -> str:
    return f'"{name}"'


def melt_sql(src: str, cols: list[str], keep: list[str] | None = None) -> str:
    """(keep..., "column", value DOUBLE) with NULLs kept, as a UNION ALL of projections."""
    keep = keep or []
    k = "".join(f"{q(c)}, " for c in keep)
    parts = [f"SELECT {k}'{c}' AS \"column\", CAST({q(c)} AS DOUBLE) AS value FROM {src}" for c in cols]
    return "(" + "\nUNION ALL ".join(parts) + ")"


def r6(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


def significant(expr: str) -> str:
    return f"(CAST(printf('%.7e', CAST({expr} AS DOUBLE)) AS DOUBLE) + 0.0)"


def lit_list(xs) -> str:
    return ", ".join(f"'{x}'" for x in xs)
