"""Releases (P36, S11, L01, L60, L61): naming, copying the previous one, repairing ids, the priority list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookups import dedup_lookup
from .merge import update_from
from .rank import latest


def next_name(existing: DataFrame, base: DataFrame) -> DataFrame:
    """For each base name, the name of the next release: the base, then '-1', then '-2'; NULL once all three
    exist.  As the checks follow each other, a free '-1' is not used while the base is free, but a taken '-1' moves on to
    '-2' whether or not the base is taken."""
    names = existing.select("name").distinct()
    hit = base
    for i, suffix in enumerate(("", "-1", "-2")):
        n = names.select(F.col("name").alias(f"_n{i}"), F.lit(1).alias(f"_h{i}"))
        hit = hit.join(n, F.concat("base", F.lit(suffix)) == F.col(f"_n{i}"), "left").withColumn(f"_h{i}", F.coalesce(f"_h{i}", F.lit(0))).drop(f"_n{i}")
    taken = F.col("_h0") + F.col("_h1") + F.col("_h2")
    name = F.when(F.col("_h1") == 1, F.concat("base", F.lit("-2"))).when(F.col("_h0") == 1, F.concat("base", F.lit("-1"))).otherwise(F.col("base"))
    return hit.withColumn("next_name", F.when(taken < 3, name)).drop("_h0", "_h1", "_h2")


def copy_previous(fact: DataFrame, release_col: str, new_release: int) -> DataFrame:
    """The facts of the latest release under a new id, marked as copies (the second-highest id once the new one is
    there)."""
    last = latest(fact, release_col, 1)
    return fact.join(F.broadcast(last), release_col, "left_semi").withColumns({
        release_col: F.lit(new_release).cast(fact.schema[release_col].dataType), "is_from_previous_release": F.lit(1)})


def repair_release_id(fact: DataFrame, releases: DataFrame, key: list[str], id_col: str) -> DataFrame:
    """The release id by (buy month, program), MAX where several match; rows without a match keep theirs."""
    return update_from(fact, releases.select(*key, id_col), key, [id_col])


def load_priority(staged: DataFrame, products: DataFrame, factories: DataFrame, release: Column) -> DataFrame:
    """Material and two factory names to ids, MAX per product; unknown materials drop out, unknown factories are
    NULL."""
    names = dedup_lookup(factories, ["short_name"], "dim_factory_id")
    f = lambda i: names.select(F.col("short_name").alias(f"factory_{i}"), F.col("dim_factory_id").alias(f"dim_factory_id_{i}"))
    j = staged.join(products.select("material_id", "dim_product_id"), "material_id").join(f(1), "factory_1", "left").join(f(2), "factory_2", "left")
    return j.groupBy("dim_product_id").agg(F.max("dim_factory_id_1").alias("dim_factory_id_1"), F.max("dim_factory_id_2").alias("dim_factory_id_2")
                                           ).withColumn("dim_release_id", release)
