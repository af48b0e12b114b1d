"""Queries for sources (S06, S07) and the penalty KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import kpi
from ..sources.scan import distinct_values, scan
from .model import Model
from .model_sql import sql
from .q_kpi import R05_LOCAL, r05_rows
from .q_reports import _run_date
from .registry import query

LINE_FILTERS = {
    "l_shipdate": ("between", ("1997-01-01", "1998-12-31")),
    "l_quantity": (">=", 10),
    "l_returnflag": ("not in", ["R", None]),
    "l_linestatus": ("in", ["O", "F"]),
    "l_discount": ("between open", (0.0, 0.1)),
}


def s06_scan_filters(spark, sf_dir):
    """S06 filter dictionary pushed to the parquet scan; S07 distinct values under a filter."""
    li = Model(spark, sf_dir).table("lineitem")
    rows = scan(li, LINE_FILTERS, ["l_suppkey", "l_quantity", "l_returnflag"])
    agg = rows.groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))
    dv = distinct_values(Model(spark, sf_dir).table("part"), "p_type", {"p_name": ("like", ["%ring%", "old%"])})
    return agg.unionByName(dv.select(F.lit(-1).cast("bigint").alias("l_suppkey"), F.col("p_type").alias("l_returnflag"),
                                     F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("qty")))


query("s06_scan_filters", sql("""
SELECT l_suppkey, l_returnflag, count(*) AS n, sum(l_quantity) AS qty FROM lineitem
WHERE l_shipdate BETWEEN '1997-01-01' AND '1998-12-31' AND l_quantity >= 10
  AND NOT coalesce(l_returnflag IN ('R') OR l_returnflag IS NULL, FALSE)
  AND l_linestatus IN ('O', 'F') AND l_discount > 0.0 AND l_discount < 0.1
GROUP BY 1, 2
UNION ALL
SELECT DISTINCT CAST(-1 AS BIGINT), p_type, CAST(0 AS BIGINT), 0.0 FROM part WHERE p_name ILIKE '%ring%' AND p_name ILIKE 'old%'
"""))(s06_scan_filters)


def r09_r10_loading_penalty(spark, sf_dir):
    """R09 penalty points per factory and horizon from the R05 fill rates; R10 best/worst ten."""
    m = Model(spark, sf_dir)
    run = _run_date(m)
    fill = r05_rows(spark, sf_dir)
    run_id = run.year * 10000 + run.month * 100 + 1
    months = ((F.floor(F.col("year_month_date_id") / 10000) - run.year) * 12
              + (F.floor(F.col("year_month_date_id") / 100) % 100 - run.month))
    h = F.when(months < 0, F.lit(None)).when(months <= 2, 1).when(months <= 5, 2).otherwise(3).cast("int")
    fill = fill.withColumn("horizon", h).filter(F.col("horizon").isNotNull() & (F.col("year_month_date_id") >= run_id))
    pen = kpi.loading_penalty(fill)
    return kpi.best_worst_by_penalty(pen, 10)


_bands = " + ".join(f"CASE WHEN fill_rate * 100 >= {hi} OR fill_rate * 100 <= {lo} THEN 1 ELSE 0 END"
                    for hi, lo in kpi.PENALTY_BANDS)
query("r09_r10_loading_penalty", sql(f"""
SELECT horizon, factory_short_name, penalty_points, rank, report_type FROM (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY horizon ORDER BY penalty_points DESC) AS INTEGER) AS rank, 'BOTTOM' AS report_type
  FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY penalty_points DESC, factory_short_name) AS rn FROM pen) a
  WHERE rn <= 10
  UNION ALL
  SELECT *, CAST(dense_rank() OVER (PARTITION BY horizon ORDER BY penalty_points) AS INTEGER), 'TOP'
  FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY penalty_points, factory_short_name) AS rn FROM pen) b
  WHERE rn <= 10) x""", "calendar", "demand", "capacity", "factory",
    local=R05_LOCAL + (("run", "SELECT CAST(date_trunc('month', max(o_orderdate)) - INTERVAL 24 MONTH AS DATE) AS r FROM orders"),
                       ("hz", """SELECT r05.*, CASE WHEN months < 0 THEN NULL WHEN months <= 2 THEN 1 WHEN months <= 5 THEN 2 ELSE 3 END AS horizon
                                 FROM (SELECT r05.*, (year_month_date_id // 10000 - year(r)) * 12 + (year_month_date_id // 100 % 100 - month(r)) AS months,
                                              year(r) * 10000 + month(r) * 100 + 1 AS run_id
                                       FROM r05, run) r05 WHERE year_month_date_id >= run_id"""),
                       ("pen", f"""SELECT horizon, factory_short_name,
                                          CAST(sum(CASE WHEN fill_rate IS NULL THEN {kpi.PENALTY_NO_FILL} ELSE {_bands} END) AS BIGINT) AS penalty_points
                                   FROM hz WHERE horizon IS NOT NULL GROUP BY 1, 2 HAVING penalty_points > 0"""))))(r09_r10_loading_penalty)
