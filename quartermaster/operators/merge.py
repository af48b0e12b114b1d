"""Merges without MERGE (M01-M04): full outer joins with an action column.  The result is the whole
new slice; the sink rewrites the slice's partition (never reading and writing one path in a plan)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge3(target: DataFrame, source: DataFrame, key: list[str], update_cols: list[str]) -> DataFrame:
    """Insert source-only rows, update ``update_cols`` of matched rows (other columns survive),
    delete target-only rows.  Returns the new slice with an ``action`` column."""
    j, t_seen, s_seen = _outer(target, source, key)
    action = F.when(t_seen & s_seen, "update").when(s_seen, "insert").otherwise("delete")
    cols = []
    for c in target.columns:
        if c in key:
            cols.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c))
        elif c in update_cols:
            cols.append(F.when(s_seen, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.col(f"t.{c}").alias(c))
    return j.select(*cols, action.alias("action")).filter(F.col("action") != "delete")


def _outer(target: DataFrame, source: DataFrame, key: list[str]) -> tuple[DataFrame, Column, Column]:
    """Full outer join on the null-safe key; a literal marker on each side tells which side a row has."""
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key])
    return t.join(s, on, "full_outer"), F.coalesce(F.col("t._in_t"), F.lit(False)), F.coalesce(F.col("s._in_s"), F.lit(False))


def upsert(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Matches take every value of the source, NULLs too, on a null-safe key; others are inserted; nothing is
    deleted.  Columns that the source lacks keep the target's value."""
    j, _, s_seen = _outer(target, source, key)
    return j.select(*[F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k) for k in key],
                    *[(F.when(s_seen, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in source.columns else F.col(f"t.{c}")).alias(c)
                      for c in target.columns if c not in key])


def upsert_keyed(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """M01 where neither side repeats a key: the same rows as ``upsert``, by one aggregate over both sides.

    Sides that are both dealt by some of the key's columns already stay where they are; a join would deal them by the whole key."""
    own = [c for c in target.columns if c not in key]
    taken = [c for c in own if c in source.columns]
    t = target.select(*key, *own, F.lit(False).alias("_in_s"))
    both = t.unionByName(source.select(*key, *taken, F.lit(True).alias("_in_s")), allowMissingColumns=True)
    rows = both.groupBy(*key).agg(F.max("_in_s").alias("_in_s"), *[F.max(F.when(~F.col("_in_s"), F.col(c))).alias(f"_t_{c}") for c in own],
                                  *[F.max(F.when(F.col("_in_s"), F.col(c))).alias(f"_s_{c}") for c in taken])
    return rows.select(*key, *[(F.when(F.col("_in_s"), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")) if c in taken else F.col(f"_t_{c}")).alias(c)
                               for c in own])


def update_from(target: DataFrame, source: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """UPDATE .. FROM a join.  The source is first reduced to one row per key (MAX per column),
    so a multi-match update is single-valued."""
    src = source.groupBy(*key).agg(*[F.max(c).alias(f"_new_{c}") for c in cols]).withColumn("_matched", F.lit(True))
    j = target.join(src, key, "left")
    return j.select(*[F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in target.columns])


def reset(df: DataFrame, cond: Column, cols: dict[str, object]) -> DataFrame:
    """Set columns to NULL / defaults on the rows of a slice."""
    return df.withColumns({c: F.when(cond, F.lit(v)).otherwise(F.col(c)) for c, v in cols.items()})
