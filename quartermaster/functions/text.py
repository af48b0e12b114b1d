"""Text scalar functions (P03, P05, P08, P13-P15, P39, P40) as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """P03 LTRIM(RTRIM(x)): blanks only (not tabs or newlines)."""
    return F.trim(_c(x))


def remove_blanks(x) -> Column:
    """P03 REPLACE(x, ' ', '')."""
    return F.replace(_c(x), F.lit(" "), F.lit(""))


def pad_key(x, width: int) -> Column:
    """Zero-padded key text of at least ``width`` characters; longer values stay whole (LPAD would cut them)."""
    s = _c(x).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def ilike_any(x, patterns: list[str]) -> Column:
    """Case-insensitive LIKE against any of ``patterns`` (the database's collation)."""
    x = _c(x)
    out = None
    for p in patterns:
        cond = x.ilike(p)
        out = cond if out is None else (out | cond)
    return out


def text_len(x) -> Column:
    """P08 LEN: trailing blanks do not count."""
    return F.length(F.rtrim(_c(x)))


def concat_nullsafe(*xs) -> Column:
    """P08 T-SQL CONCAT(): NULL parts count as ''."""
    return F.concat(*[F.coalesce(_c(x).cast("string"), F.lit("")) for x in xs])


def concat_strict(*xs) -> Column:
    """P08 ``a + b``: any NULL part makes the whole NULL."""
    return F.concat(*[_c(x).cast("string") for x in xs])


def stuff(x, start: int, length: int, insert: str) -> Column:
    """P08 STUFF(x, start, length, insert)."""
    return F.overlay(_c(x), F.lit(insert), F.lit(start), F.lit(length))


def dash_flag(x) -> Column:
    """ISNULL(x, '-') = '-' -> 0, else 1."""
    return F.when(F.coalesce(_c(x), F.lit("-")) == "-", 0).otherwise(1)


def product_type(category_text) -> Column:
    """P14: 'Vault' / 'ArcAd' / 'Regular' from the category text, case-insensitively."""
    c = _c(category_text)
    return F.when(c.ilike("%vault%"), "Vault").when(c.ilike("%arcad%"), "ArcAd").otherwise("Regular")


def gender_new(style_name) -> Column:
    """The first two characters of the style name; NULL counts as ''."""
    return F.left(F.coalesce(_c(style_name), F.lit("")), F.lit(2))


def style_id_erp(material_id) -> Column:
    """The first eight characters of the material id (the ERP's style id); NULL counts as ''."""
    return F.left(F.coalesce(_c(material_id), F.lit("")), F.lit(8))


def style_name_new(style_name) -> Column:
    """The style name without its first three characters; NULL counts as '', and STUFF of a shorter text is NULL
    only where the text is empty."""
    s = F.coalesce(_c(style_name), F.lit(""))
    return F.when(s != "", F.substr(s, F.lit(4)))


def composite_key(*xs, sep: str = "-") -> Column:
    """Text key from several columns."""
    return F.concat_ws(sep, *[_c(x).cast("string") for x in xs])


def material_strip_test_suffix(x) -> Column:
    """P40 (test variant): drop one trailing 'P'."""
    x = _c(x)
    return F.when(F.right(x, F.lit(1)) == "P", F.left(x, F.length(x) - 1)).otherwise(x)


def material_cut(x, n: int = 11) -> Column:
    """P40 (load variant) and CONVERT(NVARCHAR(n), x): keep the first ``n`` characters."""
    return F.substring(_c(x), 1, n)


def truncate_text(x, n: int) -> Column:
    """CONVERT(NVARCHAR(n), x) truncates silently."""
    return F.substring(_c(x).cast("string"), 1, n)
