"""Numeric scalar functions (P09, P11, P18, P21, P38) as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_int(x) -> Column:
    """ISNUMERIC-guarded CONVERT: text that is not a number becomes NULL."""
    return _c(x).try_cast("int")


def safe_date(x, fmt: str = "yyyy-MM-dd") -> Column:
    """ISDATE-guarded CONVERT."""
    return F.try_to_date(_c(x).cast("string"), fmt)


def percent_text(x, digits: int = 2) -> Column:
    """Ratio -> 'nn.nn%'."""
    return F.concat(F.format_number(_c(x) * 100, digits), F.lit("%"))


def pack_scaled(qty, scale) -> Column:
    """Quantity x pack scale, unless the scale is NULL or 0."""
    qty, scale = _c(qty), _c(scale)
    return F.when(F.coalesce(scale, F.lit(0)) == 0, qty).otherwise(qty * scale)


# fixed values: how numeric text may look -- optional sign, thousands commas, decimals, percent.
NUMERIC_TEXT = r"^\s*[-+]?[0-9][0-9,]*(\.[0-9]+)?\s*%?\s*$"


def is_numeric_text(x) -> Column:
    return _c(x).cast("string").rlike(NUMERIC_TEXT)


def numeric_text_to_double(x) -> Column:
    """P21: '1,234' -> 1234.0, '12%' -> 0.12; other text -> NULL."""
    s = _c(x).cast("string")
    clean = F.regexp_replace(s, r"[,\s%]", "")
    val = clean.try_cast("double")
    val = F.when(s.contains("%"), val / 100).otherwise(val)
    return F.when(is_numeric_text(s), val)


def clamp_negative(x) -> Column:
    """Negative -> 0; NULL stays NULL."""
    x = _c(x)
    return F.when(x < 0, F.lit(0)).otherwise(x)


def display_number(x, digits: int = 0) -> Column:
    """Grouped display of a number ('1,234,567')."""
    return F.format_number(_c(x), digits)
