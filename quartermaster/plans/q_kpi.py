"""Queries for the KPI operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import kpi
from .model import Model
from .model_sql import sql
from .registry import query

CAL_MONTH = ("cal", """
SELECT c.id, c.year_month_accounting, f.year_month_date_id
FROM calendar c JOIN (SELECT year_month_accounting, min(id) AS year_month_date_id FROM calendar GROUP BY 1) f
  USING (year_month_accounting)""")

R05_LOCAL = (CAL_MONTH,
             ("dem", """SELECT year_month_date_id, year_month_accounting, dim_factory_id_original AS fid,
                               sum(quantity) AS total_demand
                        FROM demand d JOIN cal ON d.dim_date_id = cal.id GROUP BY 1, 2, 3"""),
             ("cap", """SELECT year_month_accounting, dim_factory_id AS fid, sum(capacity_available_weekly) AS total_capacity
                        FROM capacity c JOIN cal ON c.week_date_id = cal.id GROUP BY 1, 2"""),
             ("r05", """SELECT dem.year_month_date_id, dem.year_month_accounting AS accounting_month,
                               f.short_name AS factory_short_name,
                               CAST(total_demand AS BIGINT) AS total_demand,
                               CAST(coalesce(total_capacity, 0) AS BIGINT) AS total_capacity,
                               CAST(CASE WHEN coalesce(total_capacity, 0) > 0 THEN total_capacity - total_demand ELSE 0 END AS BIGINT) AS discrepancy,
                               CASE WHEN coalesce(total_capacity, 0) > 0 THEN total_demand / total_capacity ELSE 0.0 END AS fill_rate
                        FROM dem LEFT JOIN cap USING (year_month_accounting, fid)
                        JOIN factory f ON f.dim_factory_id = dem.fid"""))


def r05_rows(spark, sf_dir):
    m = Model(spark, sf_dir)
    return kpi.demand_vs_capacity(m.lines, m.capacity, m.calendar, m.factory, factory_col="dim_factory_id_original")


def r05(spark, sf_dir):
    """R05 demand against capacity by accounting month and factory; the rate is rounded for the comparison only."""
    return r05_rows(spark, sf_dir).withColumn("fill_rate", F.round("fill_rate", 6))


query("r05_demand_vs_capacity", sql("SELECT * REPLACE (round(fill_rate, 6) AS fill_rate) FROM r05", "calendar", "demand", "capacity", "factory", local=R05_LOCAL))(r05)
