"""DataFrame-level cleaning helpers of the file loader.

Each returns a lazy DataFrame.  Helpers that must look at the data to decide a schema (P24, P25, P28)
run one aggregate over all rows and fetch a single row of per-column figures -- metadata, not data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dates import normalize_date_text
from .numbers import NUMERIC_TEXT, numeric_text_to_double


def normalize_name(name: str) -> str:
    """Drop special characters, blanks -> '_', lower case."""
    kept = re.sub(r"[^0-9A-Za-z _]", "", name).strip()
    return re.sub(r"\s+", "_", kept).lower()


def normalize_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(c) for c in df.columns])


def title_case(df: DataFrame, cols: list[str]) -> DataFrame:
    """P20: 'some_value' -> 'Some Value'."""
    return df.withColumns({c: F.initcap(F.translate(F.col(c), "_", " ")) for c in cols})


def numeric_columns(df: DataFrame, cols: list[str], threshold: float = 0.8) -> DataFrame:
    """Per column, the share of non-null values that look numeric (one pass, all rows).
    Returns one row: ``<col>`` -> share; a column is numeric when share >= threshold."""
    aggs = []
    for c in cols:
        v = F.col(c).cast("string")
        aggs.append((F.sum(F.when(v.isNotNull() & v.rlike(NUMERIC_TEXT), 1).otherwise(0))
                     / F.greatest(F.count(v), F.lit(1))).alias(c))
    return df.agg(*aggs)


def convert_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Numeric text columns -> double (bad values -> NULL)."""
    return df.withColumns({c: numeric_text_to_double(F.col(c)) for c in cols})


def convert_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Date text columns -> date."""
    return df.withColumns({c: normalize_date_text(F.col(c)) for c in cols})


def storage_types(df: DataFrame, cols: list[str], big: float = 1e9) -> DataFrame:
    """P25: per numeric column whether it needs 64 bits (max > 1e9), from one aggregate."""
    return df.agg(*[(F.max(F.abs(F.col(c))) > big).alias(c) for c in cols])


def concat_columns(df: DataFrame, cols: list[str], out: str, sep: str = "-") -> DataFrame:
    """Join columns as text; NULL counts as ''."""
    return df.withColumn(out, F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def display_numbers(df: DataFrame, cols: list[str], digits: int = 0, percent: tuple[str, ...] = ()) -> DataFrame:
    """Numbers -> grouped display text; percent columns as 'nn.nn%'."""
    out = {}
    for c in cols:
        if c in percent:
            out[c] = F.concat(F.format_number(F.col(c) * 100, 2), F.lit("%"))
        else:
            out[c] = F.format_number(F.col(c), digits)
    return df.withColumns(out)


def null_counts(df: DataFrame) -> DataFrame:
    """P28 step 1: non-null count of every column, one row."""
    return df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop the columns that hold no value at all (one row of counts is fetched)."""
    row = null_counts(df).first()
    return df.select(*[c for c, n in zip(df.columns, row) if n > 0])


def reorder(df: DataFrame, first: list[str]) -> DataFrame:
    """``first`` columns in order, then the rest as they were."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def transcode(df: DataFrame, col: str, mapping: dict, out: str | None = None) -> DataFrame:
    """Translate values through a dictionary (a literal map; unknown keys -> NULL)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(out or col, F.element_at(m, F.col(col)))


def remove_header_rows(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Drop rows that repeat the header inside the data (every column equals its own name,
    compared case-insensitively)."""
    names = names or df.columns
    is_header = None
    for c, n in zip(df.columns, names):
        cond = F.lower(F.col(c).cast("string")) == n.lower()
        is_header = cond if is_header is None else (is_header & cond)
    return df.filter(~F.coalesce(is_header, F.lit(False)))


def longest_pattern(paths: DataFrame, patterns: DataFrame, path_col: str = "path", pattern_col: str = "pattern") -> DataFrame:
    """For each path, the longest of the words of ``patterns`` that the path holds as a whole word (case-insensitive;
    ties: the greatest).  Paths are cut into words, so it is an equi-join, not a test of every pair."""
    words = paths.select(path_col, F.explode_outer(F.array_distinct(F.split(F.lower(path_col), "[^a-z0-9]+"))).alias("_w"))
    pats = patterns.select(F.lower(pattern_col).alias("_w"), F.col(pattern_col).alias("_p")).distinct()
    j = words.join(pats, "_w", "left")
    return j.groupBy(path_col).agg(F.max(F.struct(F.length("_p").alias("n"), F.col("_p"))).getField("_p").alias("matched_pattern"))
