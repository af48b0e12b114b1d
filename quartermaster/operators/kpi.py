"""KPI tables.

Every KPI aggregates the fact first (partial aggregation runs map-side, so a hot factory or style costs
one combined row per task, not a hot shuffle partition) and only then joins names or ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregate import snapshot_range
from .rank import top_n, top_n_per_group


def _month_of_day(calendar: DataFrame) -> DataFrame:
    """Day id -> accounting month, plus the month's first day id (J09).  The calendar is bounded by its
    parameters (one row per day), so it is broadcast."""
    first = calendar.groupBy("year_month_accounting").agg(F.min("id").alias("year_month_date_id"))
    return F.broadcast(calendar.select("id", "year_month_accounting").join(first, "year_month_accounting"))


def demand_vs_capacity(demand: DataFrame, capacity: DataFrame, calendar: DataFrame, factory: DataFrame,
                       factory_col: str = "dim_factory_id") -> DataFrame:
    """Demand and capacity per accounting month and factory; discrepancy and fill rate only
    where capacity > 0 (else both 0); months with demand but no capacity get capacity 0."""
    cal = _month_of_day(calendar)
    dem = (demand.join(cal, demand.dim_date_id == cal.id)
                 .groupBy("year_month_date_id", "year_month_accounting", F.col(factory_col).alias("fid"))
                 .agg(F.sum("quantity").alias("total_demand")))
    cap = (capacity.join(cal, capacity.week_date_id == cal.id)
                   .groupBy("year_month_accounting", F.col("dim_factory_id").alias("fid"))
                   .agg(F.sum("capacity_available_weekly").alias("total_capacity")))
    names = factory.select(F.col("dim_factory_id").alias("fid"), F.col("short_name").alias("factory_short_name"))
    j = (dem.join(cap, ["year_month_accounting", "fid"], "left")
            .join(names, "fid")
            .withColumn("total_capacity", F.coalesce("total_capacity", F.lit(0)).cast("bigint")))
    has_cap = F.col("total_capacity") > 0
    return j.select(
        "year_month_date_id",
        F.col("year_month_accounting").alias("accounting_month"),
        "factory_short_name",
        F.col("total_demand").cast("bigint").alias("total_demand"),
        "total_capacity",
        F.when(has_cap, F.col("total_capacity") - F.col("total_demand")).otherwise(F.lit(0)).cast("bigint").alias("discrepancy"),
        F.when(has_cap, F.col("total_demand") / F.col("total_capacity")).otherwise(F.lit(0.0)).alias("fill_rate"),
    )


# fixed values: the three planning horizons and their month offsets from the run month.
HORIZONS = [(1, "Month 1 to 3 (Firm)", 0, 2), (2, "Month 4 to 6 (Slush)", 3, 5), (3, "Month 7 onwards (Liquid)", 6, None)]


def horizon_of(date_col: Column, run_date_col: Column) -> Column:
    """Horizon id of a date relative to the run date's month (1 firm, 2 slush, 3 liquid).
    Dates before the run month belong to no horizon (NULL)."""
    months = (F.year(date_col) - F.year(run_date_col)) * 12 + (F.month(date_col) - F.month(run_date_col))
    return (F.when(months < 0, F.lit(None)).when(months <= 2, 1).when(months <= 5, 2).otherwise(3)).cast("int")


def horizon_name(h: Column) -> Column:
    out = None
    for hid, name, _a, _b in HORIZONS:
        out = F.when(h == hid, name) if out is None else out.when(h == hid, name)
    return out


def alternative_volumes(fact: DataFrame, factory: DataFrame, n: int = 10) -> DataFrame:
    """Over the demand that an alternative factory takes (``dim_factory_id`` differs from ``dim_factory_alternative_id``),
    the ``n`` factories that give away the most ('Going-Out') and that receive the most ('Coming-In'), ties by name."""
    moved = fact.filter(F.col("dim_factory_id") != F.col("dim_factory_alternative_id"))
    names = factory.select(F.col("dim_factory_id").alias("_id"), F.col("short_name").alias("factory_short_name"))
    out = None
    for col, kind in (("dim_factory_id", "Going-Out"), ("dim_factory_alternative_id", "Coming-In")):
        per = moved.groupBy(F.col(col).alias("_id")).agg(F.sum("quantity").alias("_q")).join(names, "_id")
        per = per.groupBy("factory_short_name").agg(F.sum("_q").cast("bigint").alias("quantity")).withColumn("report_type", F.lit(kind))
        top = top_n_per_group(top_n(per, [F.col("quantity").desc(), F.col("factory_short_name")], n), ["report_type"],
                              [F.col("quantity").desc(), F.col("factory_short_name")], n, "ranking", dense_on=[F.col("quantity").desc()])
        out = top if out is None else out.unionByName(top)
    return out


def capacity_change(capacity: DataFrame, release_col: str, month_col: str, factory_col: str, n: int = 5) -> DataFrame:
    """Per month and factory, MAX - MIN of the releases' total capacity; per factory its average and maximum, the
    ``n`` largest averages, ties by name.  ``capacity`` holds the two latest releases."""
    per = snapshot_range(capacity, [month_col, factory_col], release_col, "capacity_available_weekly")
    agg = per.groupBy(factory_col).agg(F.avg("range").alias("average_discrepancy"), F.max("range").alias("max_discrepancy"))
    top = top_n(agg, [F.col("average_discrepancy").desc(), F.col(factory_col).asc()], n).withColumn("report_type", F.lit("TOP"))
    return top_n_per_group(top, ["report_type"], [F.col("average_discrepancy").desc(), F.col(factory_col)], n, "ranking",
                           dense_on=[F.col("average_discrepancy").desc()])


# fixed values: loading-penalty bands on the monthly fill rate in percent -- (over-load at or above,
# under-load at or below); a month scores one point per band it falls outside.
PENALTY_BANDS = [(105, 90), (120, 80), (150, 50), (200, 25), (300, 15), (350, 10), (400, 5)]
PENALTY_NO_FILL = 100


def loading_penalty(fill: DataFrame, horizon_col: str = "horizon", factory_col: str = "factory_short_name") -> DataFrame:
    """Penalty points per factory and horizon summed over its months (replaces two nested cursors
    with one aggregate)."""
    pct = F.col("fill_rate") * 100
    points = sum((F.when((pct >= hi) | (pct <= lo), 1).otherwise(0) for hi, lo in PENALTY_BANDS), F.lit(0))
    points = F.when(F.col("fill_rate").isNull(), F.lit(PENALTY_NO_FILL)).otherwise(points)
    return (fill.withColumn("points", points)
                .groupBy(horizon_col, factory_col)
                .agg(F.sum("points").cast("bigint").alias("penalty_points")))


def best_worst_by_penalty(penalty: DataFrame, n: int = 10, horizon_col: str = "horizon",
                          factory_col: str = "factory_short_name") -> DataFrame:
    """Per horizon, among factories with penalty > 0, the ``n`` worst (BOTTOM, dense rank by
    points descending) and the ``n`` best (TOP, ascending); ties in the row cut broken by name."""
    pos = penalty.filter(F.col("penalty_points") > 0)
    worst = top_n_per_group(pos, [horizon_col], [F.col("penalty_points").desc(), F.col(factory_col).asc()], n,
                            dense_on=[F.col("penalty_points").desc()])
    best = top_n_per_group(pos, [horizon_col], [F.col("penalty_points").asc(), F.col(factory_col).asc()], n,
                           dense_on=[F.col("penalty_points").asc()])
    return (worst.withColumn("report_type", F.lit("BOTTOM"))
                 .unionByName(best.withColumn("report_type", F.lit("TOP"))))


def style_mix(fact: DataFrame, product: DataFrame, factory: DataFrame, horizon_col: str = "horizon",
              n: int = 10) -> DataFrame:
    """Volume per distinct product (integer division) per factory and horizon; top and bottom n."""
    agg = (fact.join(product.select("dim_product_id"), "dim_product_id").groupBy(horizon_col, "dim_factory_id")
            .agg(F.sum("quantity").alias("volume"), F.count_distinct("dim_product_id").alias("n_styles"))
            .withColumn("volume_per_style", F.expr("volume div n_styles"))
            .join(factory.select("dim_factory_id", F.col("short_name").alias("factory_short_name")), "dim_factory_id"))
    top = top_n_per_group(agg, [horizon_col], [F.col("volume_per_style").desc(), F.col("factory_short_name").asc()], n,
                          dense_on=[F.col("volume_per_style").desc()])
    bottom = top_n_per_group(agg, [horizon_col], [F.col("volume_per_style").asc(), F.col("factory_short_name").asc()], n,
                             dense_on=[F.col("volume_per_style").asc()])
    cols = [horizon_col, "factory_short_name", F.col("volume").cast("bigint").alias("volume"), "n_styles", "volume_per_style", "rank"]
    return top.select(*cols).withColumn("kind", F.lit("top")).unionByName(
        bottom.select(*cols).withColumn("kind", F.lit("bottom")))


def most_demanded(fact: DataFrame, product: DataFrame, level: str, horizon_col: str = "horizon", n: int = 10) -> DataFrame:
    """The ``n`` most demanded styles (or models) per horizon."""
    j = fact.join(product.select("dim_product_id", level), "dim_product_id")
    agg = j.groupBy(horizon_col, level).agg(F.sum("quantity").cast("bigint").alias("volume"))
    return top_n_per_group(agg, [horizon_col], [F.col("volume").desc(), F.col(level).asc()], n,
                           dense_on=[F.col("volume").desc()])
