"""Set operations and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """UNION of several blocks (duplicates removed)."""
    return reduce(lambda a, b: a.unionByName(b), dfs).distinct()


def membership(df: DataFrame, candidate: str, members: list[str], out: str) -> DataFrame:
    """INTERSECT used as a membership test -- is ``candidate`` among the (non-null) ``members``."""
    arr = F.filter(F.array(*[F.col(m) for m in members]), lambda x: x.isNotNull())
    return df.withColumn(out, F.coalesce(F.array_contains(arr, F.col(candidate)), F.lit(False)))


def unpivot_nonnull(df: DataFrame, ids: list[str], cols: list[str], name_col: str, value_col: str) -> DataFrame:
    """UNPIVOT -- one row per (id, column); NULL cells are dropped as UNPIVOT does."""
    return df.unpivot(ids, cols, name_col, value_col).filter(F.col(value_col).isNotNull())


def unpivot_keep(df: DataFrame, ids: list[str], cols: list[str], name_col: str, value_col: str,
                 prefix: str = "") -> DataFrame:
    """Generic unpivot keeping NULLs, with a column-name prefix removed."""
    out = df.unpivot(ids, cols, name_col, value_col)
    if prefix:
        out = out.withColumn(name_col, F.regexp_replace(F.col(name_col), "^" + prefix, ""))
    return out


def pivot_sum(df: DataFrame, ids: list[str], pivot_col: str, values: list, measure: str, fill: int = 0) -> DataFrame:
    """Pivot to a fixed list of columns with SUM; missing cells -> ``fill``.  Giving the values
    avoids the extra pass Spark would need to discover them."""
    out = df.groupBy(*ids).pivot(pivot_col, values).agg(F.sum(measure))
    return out.fillna(fill, subset=[str(v) for v in values])


def pivot_generic(df: DataFrame, ids: list[str], pivot_col: str, values: list, measure: str, parts: int | None = None) -> DataFrame:
    """Pre-aggregate then pivot; numbers are summed, text takes the maximum.

    A group holds a cell for each of ``values``, so ``parts`` deals the rows by ``ids`` to that many tasks, as the caller's
    row count asks for; both steps of the pivot then need no further shuffle."""
    if parts is not None:
        df = df.repartition(parts, *ids)
    numeric = isinstance(df.schema[measure].dataType, T.NumericType)
    fn = F.sum if numeric else F.max
    return df.groupBy(*ids).pivot(pivot_col, values).agg(fn(measure))
