"""Factory capacity load (L30-L35): regional shares, daily and weekly capacity, adjustment, clamping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import clamp_negative
from .lookups import dedup_lookup, mapped_dimension, resolve
from .merge import upsert_keyed
from .reshape import unpivot_nonnull

REGIONS = ["APAC", "EMEA", "CASA", "NORA"]
KEY = ["dim_factory_id", "region", "construction_type", "dim_date_id"]


def region_shares(helper: DataFrame, factory: DataFrame) -> DataFrame:
    """The shares grid (one column per region) by factory, MAX per factory, as rows; empty cells drop out."""
    ids = dedup_lookup(factory, ["short_name"], "dim_factory_id")
    grid = helper.join(ids, helper["factory_short_name"] == ids["short_name"]).groupBy("dim_factory_id").agg(
        *[F.max(r).alias(r) for r in REGIONS])
    return unpivot_nonnull(grid, ["dim_factory_id"], REGIONS, "region", "share")


def _by_factory(df: DataFrame, parts: int | None) -> DataFrame:
    """``df`` dealt by factory, to ``parts`` tasks if given: the sums, lookups and merge below all have the factory in their
    keys, so rows dealt so once stay where they are.  A factory has a row for each type and day at most, however many lines."""
    return df.repartition("dim_factory_id") if parts is None else df.repartition(parts, "dim_factory_id")


def daily_capacity(raw: DataFrame, factory: DataFrame, types: DataFrame, mapping: DataFrame, shares: DataFrame,
                   adjustment: DataFrame, calendar: DataFrame, placeholder_region: str, parts: int | None = None) -> DataFrame:
    """Raw rows (factory_name, construction_name, day, quantity, quantity_adjusted) by factory, region, type and day.

    Names resolve directly or through the mapping, else the row drops out, as does a day outside the calendar.  Without a
    share the region is the placeholder and the factor 0.25; without an adjustment the factor is 1."""
    names = dedup_lookup(factory, ["short_name"], "dim_factory_id")
    by_map = dedup_lookup(mapped_dimension(names, mapping, "Factory Master", "short_name", "dim_factory_id"), ["child"], "mapped_id")
    r = resolve(raw, [(names, [("factory_name", "short_name")], "dim_factory_id"), (by_map, [("factory_name", "child")], "mapped_id")],
                "dim_factory_id", drop_unresolved=True)
    kinds = types.select(F.col("name").alias("construction_type"), "name").distinct()
    kinds_map = dedup_lookup(mapped_dimension(kinds, mapping, "Construction Type Master", "name", "construction_type"), ["child"], "mapped_id")
    r = resolve(r, [(kinds, [("construction_name", "name")], "construction_type"), (kinds_map, [("construction_name", "child")], "mapped_id")],
                "construction_type", drop_unresolved=True)
    days = F.broadcast(calendar.select(F.col("full_date").alias("day"), F.col("id").alias("dim_date_id")))
    adj = names.join(adjustment, names["short_name"] == adjustment["factory_short_name"]).groupBy("dim_factory_id").agg(F.max("percentage").alias("adj"))
    per = _by_factory(r.join(days, "day"), parts).groupBy("dim_factory_id", "construction_type", "dim_date_id").agg(
        F.sum(F.coalesce("quantity", F.lit(0))).alias("_q"), F.sum(F.coalesce("quantity_adjusted", F.lit(0))).alias("_qa"))
    j = per.join(shares.hint("shuffle_hash"), "dim_factory_id", "left").join(adj.hint("shuffle_hash"), "dim_factory_id", "left")
    factor = F.coalesce("share", F.lit(0.25)) * F.coalesce("adj", F.lit(1.0))
    return j.select("dim_factory_id", F.coalesce("region", F.lit(placeholder_region)).alias("region"), "construction_type", "dim_date_id",
                    (F.col("_q") * factor).alias("capacity_raw_daily"), (F.col("_qa") * factor).alias("capacity_raw_daily_overwritten"),
                    F.coalesce("share", F.lit(1.0)).alias("percentage_region"), F.coalesce("adj", F.lit(1.0)).alias("percentage_from_original"))


def weekly_rollup(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Weekly sums written on the rows of the week's first day; other rows have NULL.

    A week of a factory, region and type is seven rows, summed where they are: the daily rows are not joined to themselves."""
    first = calendar.groupBy("year_cw_accounting").agg(F.min("id").alias("_first"))
    days = F.broadcast(calendar.select(F.col("id").alias("_day"), "year_cw_accounting").join(first, "year_cw_accounting").select("_day", "_first"))
    week = Window.partitionBy("dim_factory_id", "region", "construction_type", "_first")
    on_first = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in KEY], F.col("dim_date_id") == F.col("_first"))
    return (daily.join(days, daily["dim_date_id"] == days["_day"], "left")
                 .withColumns({w: F.when(on_first, F.sum(d).over(week)) for w, d in (
                     ("capacity_raw_weekly", "capacity_raw_daily"), ("capacity_raw_weekly_overwritten", "capacity_raw_daily_overwritten"))})
                 .drop("_day", "_first"))


def weekly_grid(grid: DataFrame, weeks: list[str], shares: DataFrame, factory: DataFrame, adjustment: DataFrame,
                calendar: DataFrame, placeholder_region: str, parts: int | None = None) -> DataFrame:
    """The weekly grid (factory, type, year, one column per week) as rows on the week's first day, times share and
    adjustment, MAX per key."""
    long = unpivot_nonnull(grid, ["dim_factory_id", "construction_type", "year"], weeks, "wk", "cells")
    label = F.concat(F.col("year").cast("string"), F.lit("CW"), F.right("wk", F.lit(2)))
    first = F.broadcast(calendar.groupBy("year_cw_accounting").agg(F.min("id").alias("dim_date_id")))
    names = dedup_lookup(factory, ["short_name"], "dim_factory_id")
    adj = names.join(adjustment, names["short_name"] == adjustment["factory_short_name"]).groupBy("dim_factory_id").agg(F.max("percentage").alias("adj"))
    j = (_by_factory(long.withColumn("year_cw_accounting", label).join(first, "year_cw_accounting"), parts)
             .join(shares.hint("shuffle_hash"), "dim_factory_id", "left").join(adj.hint("shuffle_hash"), "dim_factory_id", "left")
             .withColumn("region", F.coalesce("region", F.lit(placeholder_region))))
    value = F.col("cells") * F.coalesce("share", F.lit(0.25)) * F.coalesce("adj", F.lit(1.0))
    return j.groupBy(*KEY).agg(F.max(value).alias("capacity_available_weekly"))


def load_capacity(daily: DataFrame, weekly: DataFrame, factory: DataFrame, adjustment: DataFrame) -> DataFrame:
    """L34 + L35: weekly capacity is inserted where the key has no row and updated where it has; then adjusted by the
    factory's percentage, and negative figures become 0.  Both sides hold a key once."""
    out = upsert_keyed(daily.withColumn("capacity_available_weekly", F.lit(0.0)), weekly, KEY)
    names = dedup_lookup(factory, ["short_name"], "dim_factory_id")
    second = names.join(adjustment, names["short_name"] == adjustment["factory_short_name"]).groupBy("dim_factory_id").agg(
        F.max("percentage_adjustment").alias("_pct"))
    # hashed in the tasks that the rows are dealt to: the rows are not sorted
    out = out.join(second.hint("shuffle_hash"), "dim_factory_id", "left").withColumn(
        "capacity_available_weekly_adjusted", F.col("capacity_available_weekly") * F.col("_pct")).drop("_pct")
    figures = ["capacity_raw_weekly", "capacity_raw_daily_overwritten", "capacity_raw_weekly_overwritten",
               "capacity_available_weekly", "capacity_available_weekly_adjusted"]
    return out.withColumns({c: clamp_negative(c) for c in figures})
