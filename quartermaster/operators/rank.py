"""Windows, sorts, limits and top-k.

No operator here puts a whole table into one task:
  * top-N over a table is ``orderBy(...).limit(n)`` -- Spark plans TakeOrderedAndProject, a per-task
    top-N followed by a merge of n rows per task;
  * top-N per group filters ``row_number() <= n``; Spark's WindowGroupLimit then keeps only n rows per
    group inside each map task before the shuffle, so one huge group ships at most n rows per task;
  * a global rank over a large aggregate ranks the distinct values in explicit, ordered buckets;
  * de-duplication is an aggregate (partial, map-side), never a window over a possibly hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows in ``order`` (include a key in ``order`` to make ties stable)."""
    return df.orderBy(*_cols(order)).limit(n)


def top_n_per_group(df: DataFrame, group: list, order: list, n: int, rank_col: str = "rank",
                    dense_on: list | None = None) -> DataFrame:
    """First ``n`` rows of every group in ``order``.  With ``dense_on`` the reported rank is the dense
    rank of those rows by ``dense_on`` (TOP n + DENSE_RANK); otherwise the row number."""
    w = Window.partitionBy(*_cols(group)).orderBy(*_cols(order))
    kept = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    if dense_on is None:
        return kept.withColumnRenamed("_rn", rank_col)
    # the kept rows are a prefix of the group in dense_on order, so their dense rank is the group's
    w2 = Window.partitionBy(*_cols(group)).orderBy(*_cols(dense_on))
    return kept.drop("_rn").withColumn(rank_col, F.dense_rank().over(w2))


def rank_label(rank: Column, n: int = 50, inside: str = "Top 50", outside: str = "Others") -> Column:
    """Label rows whose rank is between 1 and n."""
    return F.when(rank.between(1, n), inside).otherwise(outside)


def global_rank(df: DataFrame, metric: str, out: str = "rank", ascending: bool = False, dense: bool = False,
                partitions: int | None = None) -> DataFrame:
    """RANK() (or DENSE_RANK()) OVER (ORDER BY metric) over a table of any size.

    Only the distinct values with their counts are ranked.  Explicit bounds (approximate quantiles, fetched once) deal
    them into ordered buckets by plain comparison, so every branch of the plan sees the same buckets; a value's rank is
    the rows (distinct values for a dense rank) of the buckets before, from one row per bucket, plus those before it in
    its own bucket, plus one.  The ranks are joined back on the value; NULLs come last.
    """
    n = max(1, partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    m, v = F.col(metric), F.col("_v")
    order = v.asc_nulls_last() if ascending else v.desc_nulls_last()
    values = df.groupBy(m.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    found = df.agg(F.percentile_approx(m, [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0]
    bounds = sorted(set(found or []), reverse=not ascending)
    bucket = F.lit(len(bounds))  # between the bounds, in the order of the ranking
    for i in range(len(bounds) - 1, -1, -1):
        bucket = F.when(v <= bounds[i] if ascending else v >= bounds[i], i).otherwise(bucket)
    values = values.withColumn("_b", F.when(v.isNull(), len(bounds) + 1).otherwise(bucket))
    step = F.lit(1) if dense else F.col("_n")
    totals = values.groupBy("_b").agg(F.sum(step).alias("_t"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    offsets = F.broadcast(totals.select("_b", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off")))
    within = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (values.withColumn("_in", F.coalesce(F.sum(step).over(within), F.lit(0))).join(offsets, "_b")
                   .select("_v", (F.col("_off") + F.col("_in") + 1).cast("bigint").alias(out)))
    return df.join(ranks, m.eqNullSafe(ranks["_v"]), "left").drop("_v")


def dedupe(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key.  The kept row is the smallest by ``order`` (default: all other columns),
    chosen by an aggregate so a hot key is combined map-side instead of sorted in one task."""
    others = [c for c in df.columns if c not in keys]
    order = order or others
    rest = [c for c in others if c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    return (df.groupBy(*keys).agg(F.min(packed).alias("_r"))
              .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]))


def latest(df: DataFrame, id_col: str, n: int = 1) -> DataFrame:
    """The ``n`` highest ids (n=2 gives the latest and the previous release)."""
    return df.select(id_col).distinct().orderBy(F.col(id_col).desc()).limit(n)
