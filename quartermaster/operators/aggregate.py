"""Aggregations (A01-A11).  All are hash aggregates with map-side partial aggregation; the one
write-back (A08) is a grouped aggregate joined back on the key, not a window, so a hot key is
pre-combined before the shuffle instead of being sorted inside a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FN = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count, "avg": F.avg, "mean": F.avg,
       "count_distinct": F.count_distinct, "first": F.first}


def aggregate(df: DataFrame, by: list, spec: dict[str, list[str]], rename: dict[str, str] | None = None) -> DataFrame:
    """Dict of column -> functions; output names ``<col>_<fn>`` unless renamed."""
    rename = rename or {}
    aggs = []
    for col, fns in spec.items():
        for fn in fns:
            name = f"{col}_{fn}"
            aggs.append(_FN[fn](F.col(col)).alias(rename.get(name, name)))
    return df.groupBy(*by).agg(*aggs)


def having(agg_df: DataFrame, cond: Column) -> DataFrame:
    """Filter after the aggregate (Catalyst pushes key-only conditions below it)."""
    return agg_df.filter(cond)


def ratio_per_distinct(df: DataFrame, by: list[str], measure: str, distinct_col: str, out: str) -> DataFrame:
    """SUM(measure) / COUNT(DISTINCT x) with integer division (of integers, by ``div``)."""
    return (df.groupBy(*by).agg(F.sum(measure).alias("_s"), F.count_distinct(distinct_col).alias("_n"))
              .withColumn(out, F.expr("_s div _n"))
              .drop("_s", "_n"))


def product_of_aggregates(df: DataFrame, by: list[str], qty: str, pct: str, adj: str, out: str) -> DataFrame:
    """SUM(q) * MAX(pct) * MAX(adj), truncated to an integer."""
    return df.groupBy(*by).agg((F.sum(qty) * F.max(pct) * F.max(adj)).cast("bigint").alias(out))


def group_total(df: DataFrame, by: list[str], col: str, out: str) -> DataFrame:
    """Write each group's total back onto every row of the group."""
    totals = df.groupBy(*by).agg(F.sum(col).alias(out))
    return df.join(totals, by, "left")


def snapshot_range(df: DataFrame, by: list[str], snap_col: str, measure: str) -> DataFrame:
    """Per key, MAX - MIN over per-snapshot totals, and their average."""
    per = df.groupBy(*by, snap_col).agg(F.sum(measure).alias("_t"))
    return per.groupBy(*by).agg((F.max("_t") - F.min("_t")).alias("range"), F.avg("_t").alias("avg"))


def counts(df: DataFrame, conds: dict[str, Column]) -> DataFrame:
    """Several conditional row counts in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.sum(F.when(c, 1).otherwise(0)).cast("bigint").alias(n) for n, c in conds.items()])
