"""Queries for report and KPI operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import kpi
from ..operators.lookups import scalar
from .model import Model
from .model_sql import sql
from .registry import query


def _run_date(m: Model):
    """The run date: first of the month two years before the latest order (a scalar variable)."""
    return scalar(m.table("orders").agg(F.add_months(F.trunc(F.max("o_orderdate"), "MM"), -24).cast("date").alias("r")))["r"]


def r12_most_demanded_styles(spark, sf_dir):
    """R06 planning horizons + R12 the ten most demanded styles per horizon (dense rank, key ties)."""
    m = Model(spark, sf_dir)
    run = _run_date(m)
    d = m.demand.withColumn("horizon", kpi.horizon_of(F.col("demand_date"), F.lit(run))).filter(F.col("horizon").isNotNull())
    return kpi.most_demanded(d, m.product, "style_id", n=10)


query("r12_most_demanded_styles", sql("""
SELECT horizon, style_id, volume, CAST(dense_rank() OVER (PARTITION BY horizon ORDER BY volume DESC) AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY volume DESC, style_id) AS rn
      FROM (SELECT horizon, style_id, CAST(sum(quantity) AS BIGINT) AS volume
            FROM (SELECT d.*, CASE WHEN months < 0 THEN NULL WHEN months <= 2 THEN 1 WHEN months <= 5 THEN 2 ELSE 3 END AS horizon
                  FROM (SELECT *, (year(demand_date) - year(r)) * 12 + (month(demand_date) - month(r)) AS months
                        FROM demand, run) d) h
            JOIN product USING (dim_product_id)
            WHERE horizon IS NOT NULL GROUP BY 1, 2) a) b
WHERE rn <= 10""", "demand", "product",
    local=(("run", "SELECT CAST(date_trunc('month', max(o_orderdate)) - INTERVAL 24 MONTH AS DATE) AS r FROM orders"),)))(r12_most_demanded_styles)


def r13_volume_summary(spark, sf_dir):
    """R13 volume summaries: category x accounting month, and ASAP-like (lead < 30 days) x region."""
    m = Model(spark, sf_dir)
    cal = F.broadcast(m.calendar.select("id", "year_month_accounting"))
    d = m.demand.join(cal, m.demand.dim_date_id == cal.id)
    by_month = d.groupBy(F.col("demand_category").alias("k1"), F.col("year_month_accounting").alias("k2")) \
                .agg(F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("n_lines")) \
                .withColumn("summary", F.lit("category_month"))
    asap = m.demand.join(m.customer.select("dim_customer_id", "region"), "dim_customer_id") \
                   .withColumn("k1", F.when(F.datediff("demand_date", "release_date") < 30, "ASAP").otherwise("Dated")) \
                   .groupBy("k1", F.col("region").alias("k2")) \
                   .agg(F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("n_lines")) \
                   .withColumn("summary", F.lit("asap_region"))
    return by_month.unionByName(asap)


query("r13_volume_summary", sql("""
SELECT demand_category AS k1, year_month_accounting AS k2, CAST(sum(quantity) AS BIGINT) AS quantity, count(*) AS n_lines,
       'category_month' AS summary
FROM demand JOIN calendar ON dim_date_id = id GROUP BY 1, 2
UNION ALL
SELECT CASE WHEN date_diff('day', release_date, demand_date) < 30 THEN 'ASAP' ELSE 'Dated' END, region,
       CAST(sum(quantity) AS BIGINT), count(*), 'asap_region'
FROM demand JOIN customer USING (dim_customer_id) GROUP BY 1, 2""", "demand", "calendar", "customer"))(r13_volume_summary)


def r15_forecast_summary(spark, sf_dir):
    """R15 forecast summary by release, month, customer region."""
    m = Model(spark, sf_dir)
    f = m.demand.filter(F.col("demand_category") == "Forecast").join(m.customer.select("dim_customer_id", "region"), "dim_customer_id")
    return f.groupBy("dim_release_id", F.date_format("demand_date", "yyyy-MM").alias("month"), "region") \
            .agg(F.sum("quantity").alias("quantity"), F.count_distinct("dim_customer_id").alias("n_customers"))


query("r15_forecast_summary", sql("""
SELECT dim_release_id, strftime(demand_date, '%Y-%m') AS month, region, CAST(sum(quantity) AS BIGINT) AS quantity,
       count(DISTINCT dim_customer_id) AS n_customers
FROM demand JOIN customer USING (dim_customer_id) WHERE demand_category = 'Forecast' GROUP BY 1, 2, 3""",
    "demand", "customer"))(r15_forecast_summary)


def r18_order_status(spark, sf_dir):
    """R18 order status split (open / shipped) with first and last dates, by month of the order."""
    d = Model(spark, sf_dir).demand.filter(F.col("demand_category") == "Order")
    status = F.when(F.col("line_status") == "O", "Open").when(F.col("line_status") == "F", "Shipped").otherwise("Received")
    return d.groupBy(status.alias("status"), F.date_format("release_date", "yyyy-MM").alias("order_month")) \
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("quantity"),
                 F.min("dim_date_id").alias("first_date_id"), F.max("dim_date_id").alias("last_date_id"))


query("r18_order_status", sql("""
SELECT CASE WHEN line_status = 'O' THEN 'Open' WHEN line_status = 'F' THEN 'Shipped' ELSE 'Received' END AS status,
       strftime(release_date, '%Y-%m') AS order_month, count(*) AS n_lines, CAST(sum(quantity) AS BIGINT) AS quantity,
       min(dim_date_id) AS first_date_id, max(dim_date_id) AS last_date_id
FROM demand WHERE demand_category = 'Order' GROUP BY 1, 2""", "demand"))(r18_order_status)


def r11_style_mix(spark, sf_dir):
    """R11 volume per distinct product (integer division) per factory and horizon; top and bottom ten."""
    m = Model(spark, sf_dir)
    run = _run_date(m)
    d = (m.demand.withColumn("horizon", kpi.horizon_of(F.col("demand_date"), F.lit(run)))
                 .filter(F.col("horizon").isNotNull())
                 .withColumnRenamed("dim_factory_id_original", "dim_factory_id"))
    return kpi.style_mix(d, m.product, m.factory, n=10)


_R11_BASE = """SELECT horizon, f.short_name AS factory_short_name, CAST(sum(quantity) AS BIGINT) AS volume,
       count(DISTINCT dim_product_id) AS n_styles, CAST(sum(quantity) // count(DISTINCT dim_product_id) AS BIGINT) AS volume_per_style
FROM (SELECT d.*, CASE WHEN months < 0 THEN NULL WHEN months <= 2 THEN 1 WHEN months <= 5 THEN 2 ELSE 3 END AS horizon
      FROM (SELECT *, (year(demand_date) - year(r)) * 12 + (month(demand_date) - month(r)) AS months FROM demand, run) d) h
JOIN product USING (dim_product_id) JOIN factory f ON f.dim_factory_id = h.dim_factory_id_original
WHERE horizon IS NOT NULL GROUP BY 1, 2"""

query("r11_style_mix", sql("""
SELECT horizon, factory_short_name, volume, n_styles, volume_per_style, rank, kind FROM (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY horizon ORDER BY volume_per_style DESC) AS INTEGER) AS rank, 'top' AS kind
  FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY volume_per_style DESC, factory_short_name) AS rn FROM agg) a WHERE rn <= 10
  UNION ALL
  SELECT *, CAST(dense_rank() OVER (PARTITION BY horizon ORDER BY volume_per_style) AS INTEGER), 'bottom'
  FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY volume_per_style, factory_short_name) AS rn FROM agg) b WHERE rn <= 10) x""",
    "demand", "product", "factory",
    local=(("run", "SELECT CAST(date_trunc('month', max(o_orderdate)) - INTERVAL 24 MONTH AS DATE) AS r FROM orders"),
           ("agg", _R11_BASE))))(r11_style_mix)
