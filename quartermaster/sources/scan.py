"""Table source with a filter dictionary (S06) and distinct values under a filter.

The dictionary becomes one Catalyst predicate, so it reaches the parquet scan as pushed filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def predicate(col: str, op: str, value) -> Column:
    """One filter: between, between open, ==, >=, >, <, <=, in / not in (both NULL-aware: a NULL in
    the list also matches / excludes NULL), like (case-insensitive, every pattern must match)."""
    c = F.col(col)
    op = op.lower()
    if op == "between":
        return c.between(value[0], value[1])
    if op == "between open":
        return (c > value[0]) & (c < value[1])
    if op in ("==", "="):
        return c == value
    if op == ">=":
        return c >= value
    if op == ">":
        return c > value
    if op == "<":
        return c < value
    if op == "<=":
        return c <= value
    if op in ("in", "not in"):
        vals = [v for v in value if v is not None]
        has_null = len(vals) != len(value)
        inside = c.isin(vals) | (c.isNull() if has_null else F.lit(False))
        return inside if op == "in" else ~F.coalesce(inside, F.lit(False))
    if op == "like":
        pats = value if isinstance(value, (list, tuple)) else [value]
        return reduce(lambda a, b: a & b, [c.ilike(p) for p in pats])
    raise ValueError(f"unknown filter operator {op}")


def scan(df: DataFrame, filters: dict[str, tuple[str, object]] | None = None, columns: list[str] | None = None) -> DataFrame:
    """``filters`` maps column -> (operator, value); all filters must hold."""
    out = df
    if filters:
        out = out.filter(reduce(lambda a, b: a & b, [predicate(c, op, v) for c, (op, v) in filters.items()]))
    return out.select(*columns) if columns else out


def distinct_values(df: DataFrame, col: str, filters: dict | None = None) -> DataFrame:
    """Distinct values of a column under a filter."""
    return scan(df, filters, [col]).distinct()
