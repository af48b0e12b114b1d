"""Conditional scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def case(branches: list[tuple[Column, object]], default=None) -> Column:
    """P01 searched CASE: first true condition wins."""
    out = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def simple_case(x, mapping: dict, default=None) -> Column:
    """P01 simple CASE x WHEN k THEN v."""
    x = _c(x)
    return case([(x == k, v) for k, v in mapping.items()], default)


def first_non_null(*xs) -> Column:
    """P02 ISNULL chain: direct key -> mapped key -> placeholder."""
    return F.coalesce(*[x if isinstance(x, Column) else (F.col(x) if isinstance(x, str) else F.lit(x)) for x in xs])


def not_in(x, values: list) -> Column:
    """P04 NOT IN (literals): a NULL input gives NULL, so the row is filtered out, as in SQL."""
    return ~_c(x).isin(values)


def band(x, bands: list[tuple[float | None, float | None, str]], default=None) -> Column:
    """Label of the first (lo, hi) BETWEEN band containing x (open ends as None)."""
    x = _c(x)
    out = []
    for lo, hi, label in bands:
        if lo is None:
            cond = x <= hi
        elif hi is None:
            cond = x >= lo
        else:
            cond = x.between(lo, hi)
        out.append((cond, label))
    return case(out, default)


def yes_no(x) -> Column:
    """Flag 1 -> 'Y', else 'N'."""
    return F.when(_c(x) == 1, "Y").otherwise("N")


def asap_label(is_asap, date_text) -> Column:
    """is_asap = 1 -> 'ASAP', else the date text."""
    return F.when(_c(is_asap) == 1, "ASAP").otherwise(_c(date_text).cast("string"))


def currency(customer_name, factory_country, customer: str, country: str) -> Column:
    """RMB where ``customer`` buys from a final factory in ``country``, else USD."""
    return F.when((_c(customer_name) == customer) & (_c(factory_country) == country), "RMB").otherwise("USD")


def by_region(region, choices: dict[str, Column], default: Column) -> Column:
    """Region-dependent column choice."""
    r = _c(region)
    return case([(r == k, v) for k, v in choices.items()], default)


def default_if_null(x, value) -> Column:
    """Fill a NULL before load (construction type -> 'NA')."""
    return F.coalesce(_c(x), F.lit(value))
