"""Queries for joins (J*), aggregates (A*), windows / top-k (W*) and reshaping (U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import aggregate as agg
from ..operators import lookups as lk
from ..operators import rank, reshape
from .model import Model
from .model_sql import date_id, pad, sql
from .registry import query


# ------------------------------------------------------------------------------------------ joins
def j_star_roles(spark, sf_dir):
    """J01 star join, J03 one dimension in several roles (factory: original and first priority;
    calendar: demand date and release date), J20 theta filter date >= release month start."""
    m = Model(spark, sf_dir)
    d = (m.demand.join(m.priority, "dim_product_id", "left")
                 .withColumn("release_date_id", dates.date_id("release_date"))
                 .filter(F.col("dim_date_id") >= F.col("release_date_id")))
    cal = F.broadcast(m.calendar)   # bounded by its parameters
    s = lk.star_join(d, [(m.factory, "dim_factory_id_original", "dim_factory_id", "orig", ["country_code"]),
                         (m.factory, "dim_factory_id_1", "dim_factory_id", "prio", ["country_code"]),
                         (cal, "dim_date_id", "id", "demand", ["year_accounting"]),
                         (cal, "release_date_id", "id", "release", ["year_accounting"])])
    return (s.groupBy("orig_country_code", "prio_country_code", "demand_year_accounting", "release_year_accounting")
             .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("quantity")))


query("j_star_roles", sql(f"""
SELECT fo.country_code AS orig_country_code, fp.country_code AS prio_country_code,
       cd.year_accounting AS demand_year_accounting, cr.year_accounting AS release_year_accounting,
       count(*) AS n_lines, CAST(sum(quantity) AS BIGINT) AS quantity
FROM (SELECT d.*, p.dim_factory_id_1, {date_id('release_date')} AS release_date_id
      FROM demand d LEFT JOIN priority p USING (dim_product_id)) d
LEFT JOIN factory fo ON d.dim_factory_id_original = fo.dim_factory_id
LEFT JOIN factory fp ON d.dim_factory_id_1 = fp.dim_factory_id
LEFT JOIN calendar cd ON d.dim_date_id = cd.id
LEFT JOIN calendar cr ON d.release_date_id = cr.id
WHERE d.dim_date_id >= d.release_date_id
GROUP BY ALL""", "demand", "priority", "factory", "calendar"))(j_star_roles)

PLACEHOLDER_CUSTOMER = -1


def _staged_customer_text(o):
    k = o.o_orderkey % 4
    ck = F.col("o_custkey")
    return (F.when(k == 0, F.concat(F.lit("Customer#"), text.pad_key(ck, 9)))
             .when(k == 1, F.concat(F.lit("DC"), text.pad_key(ck, 6)))
             .when(k == 2, F.concat(F.lit("OLD"), ck.cast("string")))
             .otherwise(F.concat(F.lit("UNKNOWN"), ck.cast("string"))))


def j_resolve_customer(spark, sf_dir):
    """J06 three-way resolution (name -> DC code -> mapped code -> placeholder), J05 mapped lookup,
    J07 de-duplicated lookup (MAX id per name), P02 first-non-null chain."""
    m = Model(spark, sf_dir)
    o = m.table("orders")
    staged = o.select(o.o_orderkey, (o.o_orderkey % 4).alias("variant"), _staged_customer_text(o).alias("customer_text"))
    cust = m.table("customer")
    by_name = lk.dedup_lookup(cust.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id")), ["name"], "id")
    by_dc = lk.dedup_lookup(cust.select(F.concat(F.lit("DC"), text.pad_key("c_custkey", 6)).alias("dc_code"),
                                        F.col("c_custkey").alias("id")), ["dc_code"], "id")
    # mapping rule table (category, parent, child): retired codes of every tenth customer -> DC code
    mapping = cust.filter(F.col("c_custkey") % 10 == 0).select(
        F.lit("Customer Master").alias("category"),
        F.concat(F.lit("DC"), text.pad_key("c_custkey", 6)).alias("parent"),
        F.concat(F.lit("OLD"), F.col("c_custkey").cast("string")).alias("child"))
    by_map = lk.mapped_dimension(by_dc.withColumnRenamed("id", "cid"), mapping, "Customer Master", "dc_code", "cid")
    r = lk.resolve(staged, [(by_name, [("customer_text", "name")], "id"),
                            (by_dc, [("customer_text", "dc_code")], "id"),
                            (by_map, [("customer_text", "child")], "mapped_id")],
                   "dim_customer_id", placeholder=PLACEHOLDER_CUSTOMER)
    return (r.groupBy("variant")
             .agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(F.when(F.col("dim_customer_id") == PLACEHOLDER_CUSTOMER, 1).otherwise(0)).alias("n_placeholder"),
                  F.sum("dim_customer_id").alias("sum_customer_id")))


query("j_resolve_customer", sql(f"""
SELECT variant, count(*) AS n_rows,
       CAST(sum(CASE WHEN dim_customer_id = {PLACEHOLDER_CUSTOMER} THEN 1 ELSE 0 END) AS BIGINT) AS n_placeholder,
       CAST(sum(dim_customer_id) AS BIGINT) AS sum_customer_id
FROM (SELECT o_orderkey % 4 AS variant,
             coalesce(n.id, dc.c_custkey, mp.c_custkey, {PLACEHOLDER_CUSTOMER}) AS dim_customer_id
      FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Customer#' || ({pad('o_custkey', 9)})
                                      WHEN 1 THEN 'DC' || ({pad('o_custkey', 6)})
                                      WHEN 2 THEN 'OLD' || CAST(o_custkey AS VARCHAR)
                                      ELSE 'UNKNOWN' || CAST(o_custkey AS VARCHAR) END AS t FROM orders) s
      LEFT JOIN (SELECT c_name AS name, max(c_custkey) AS id FROM customer GROUP BY c_name) n ON s.t = n.name
      LEFT JOIN customer dc ON s.t = 'DC' || ({pad('dc.c_custkey', 6)})
      LEFT JOIN customer mp ON mp.c_custkey % 10 = 0 AND s.t = 'OLD' || CAST(mp.c_custkey AS VARCHAR)) r
GROUP BY variant"""))(j_resolve_customer)


def j_anti_semi(spark, sf_dir):
    """J11 left anti (LEFT JOIN .. IS NULL), J12 semi (IN subquery), J13 NOT EXISTS, J14 NOT IN,
    J16 delete detection (target rows missing from the new source)."""
    m = Model(spark, sf_dir)
    d = m.demand
    products = m.product.select("dim_product_id")
    rows = [
        ("products_without_demand", lk.anti(products, m.lines.select("dim_product_id").distinct(), "dim_product_id")),
        ("customers_with_demand", lk.semi(m.customer.select("dim_customer_id"), d.select("dim_customer_id").distinct(), "dim_customer_id")),
        ("factories_never_first_priority", lk.anti(m.factory.select("dim_factory_id"),
                                                   m.priority.select(F.col("dim_factory_id_1").alias("dim_factory_id")),
                                                   "dim_factory_id")),
        ("forecast_products_dropped_from_orders",
         lk.anti(d.filter(F.col("demand_category") == "Forecast").select("dim_product_id").distinct(),
                 d.filter(F.col("demand_category") == "Order").select("dim_product_id"), "dim_product_id")),
    ]
    out = None
    for name, df in rows:
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check_name"), "n")
        out = c if out is None else out.unionByName(c)
    return out


query("j_anti_semi", sql("""
SELECT 'products_without_demand' AS check_name, count(*) AS n FROM product p
  WHERE NOT EXISTS (SELECT 1 FROM demand d WHERE d.dim_product_id = p.dim_product_id)
UNION ALL
SELECT 'customers_with_demand', count(*) FROM customer c WHERE dim_customer_id IN (SELECT dim_customer_id FROM demand)
UNION ALL
SELECT 'factories_never_first_priority', count(*) FROM factory f
  WHERE dim_factory_id NOT IN (SELECT dim_factory_id_1 FROM priority)
UNION ALL
SELECT 'forecast_products_dropped_from_orders', count(*) FROM
  (SELECT DISTINCT dim_product_id FROM demand WHERE demand_category = 'Forecast') t
  WHERE NOT EXISTS (SELECT 1 FROM demand o WHERE o.demand_category = 'Order' AND o.dim_product_id = t.dim_product_id)
""", "demand", "product", "customer", "factory", "priority"))(j_anti_semi)


def _week_label(k, w):
    return (F.when(k % 3 == 0, F.concat(F.lit("CW"), w.cast("string")))
             .when(k % 3 == 1, F.concat(F.lit("CW "), F.lpad(w.cast("string"), 2, "0")))
             .otherwise(F.lit("CWxx")))


def j_week_text(spark, sf_dir):
    """J08 join on a week number parsed from free text (non-numeric -> 0), J09 first day of the
    fiscal week, R19 unmatched week labels (NULL Monday)."""
    m = Model(spark, sf_dir)
    o = m.table("orders")
    k = F.col("o_orderkey")
    w = (k % 52 + 1)
    staged = o.select(k.alias("order_id"), F.year("o_orderdate").alias("year"), _week_label(k, w).alias("week_label"))
    staged = staged.withColumn("week", lk.week_from_text("week_label"))
    week_start = (m.calendar.groupBy("year_accounting", "week_accounting").agg(F.min("id").alias("week_start_id")))
    monday = F.broadcast(week_start.join(F.broadcast(m.calendar.select("id", "full_date")), F.col("week_start_id") == F.col("id"))
                         .select("year_accounting", "week_accounting",
                                 dates.date_id(F.date_add("full_date", 1)).alias("monday_id")))
    j = staged.join(monday, (staged.year == monday.year_accounting) & (staged.week == monday.week_accounting), "left")
    return j.select("order_id", "week_label", "week", "monday_id")


query("j_week_text", sql(f"""
SELECT order_id, week_label, week, monday_id
FROM (SELECT order_id, year, week_label,
             coalesce(TRY_CAST(replace(substr(week_label, 3, 10), ' ', '') AS INTEGER), 0) AS week
      FROM (SELECT o_orderkey AS order_id, year(o_orderdate) AS year,
                   CASE o_orderkey % 3 WHEN 0 THEN 'CW' || CAST(o_orderkey % 52 + 1 AS VARCHAR)
                                       WHEN 1 THEN 'CW ' || lpad(CAST(o_orderkey % 52 + 1 AS VARCHAR), 2, '0')
                                       ELSE 'CWxx' END AS week_label FROM orders) a) s
LEFT JOIN (SELECT year_accounting, week_accounting, {date_id('min(full_date) + 1')} AS monday_id
           FROM calendar GROUP BY 1, 2) c
  ON s.year = c.year_accounting AND s.week = c.week_accounting""", "calendar"))(j_week_text)


def j_band_horizon(spark, sf_dir):
    """J19 band join of month ids into the three planning horizons (R06), P35 scalar variables."""
    m = Model(spark, sf_dir)
    d = m.demand.withColumn("month_id", dates.date_id(dates.month_start("demand_date")))
    run = lk.scalar(m.table("orders").agg(F.add_months(F.trunc(F.max("o_orderdate"), "MM"), -24).cast("date").alias("run")))["run"]
    last = lk.scalar(d.agg(F.max("month_id").alias("last")))["last"]

    def month_id(n):
        y, mth = divmod(run.year * 12 + run.month - 1 + n, 12)
        return y * 10000 + (mth + 1) * 100 + 1
    # the three horizons: a table of fixed size built from the two scalars
    bands = spark.createDataFrame([(1, "Month 1 to 3 (Firm)", month_id(0), month_id(2)),
                                   (2, "Month 4 to 6 (Slush)", month_id(3), month_id(5)),
                                   (3, "Month 7 onwards (Liquid)", month_id(6), int(last))],
                                  "horizon int, horizon_name string, start_date_id int, end_date_id int")
    j = lk.band_join(d, bands, "month_id")
    return j.groupBy("horizon", "horizon_name").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("quantity"))


query("j_band_horizon", sql(f"""
SELECT horizon, horizon_name, count(*) AS n_lines, CAST(sum(quantity) AS BIGINT) AS quantity
FROM (SELECT *, {date_id("date_trunc('month', demand_date)")} AS month_id FROM demand) d
JOIN (SELECT 1 AS horizon, 'Month 1 to 3 (Firm)' AS horizon_name, {date_id('r')} AS s, {date_id('r + INTERVAL 2 MONTH')} AS e FROM run
      UNION ALL SELECT 2, 'Month 4 to 6 (Slush)', {date_id('r + INTERVAL 3 MONTH')}, {date_id('r + INTERVAL 5 MONTH')} FROM run
      UNION ALL SELECT 3, 'Month 7 onwards (Liquid)', {date_id('r + INTERVAL 6 MONTH')},
                       (SELECT max({date_id("date_trunc('month', demand_date)")}) FROM demand) FROM run) b
  ON d.month_id BETWEEN b.s AND b.e
GROUP BY horizon, horizon_name""", "demand",
    local=(("run", "SELECT CAST(date_trunc('month', max(o_orderdate)) - INTERVAL 24 MONTH AS DATE) AS r FROM orders"),)))(j_band_horizon)


def j_many_bands(spark, sf_dir):
    """J19 with as many bands as there are parts: the lines whose material lies in a part's band, by the part's size."""
    m = Model(spark, sf_dir)
    key, size = F.col("p_partkey"), F.col("p_size")
    bands = m.table("part").select("p_size", (key * 3 - size % 9).alias("lo"), (key * 3 + size % 25).alias("hi"))
    j = lk.band_join(m.lines.select("dim_product_id", "quantity"), bands, "dim_product_id", "lo", "hi", "left")
    return j.groupBy("p_size").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("quantity"))


query("j_many_bands", sql("""
SELECT p_size, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem LEFT JOIN part ON l_partkey BETWEEN p_partkey * 3 - p_size % 9 AND p_partkey * 3 + p_size % 25 GROUP BY 1"""))(j_many_bands)


def j_merge_frames(spark, sf_dir):
    """J21 configurable merge (aggregate the right side first, keep left columns), J22 vertical fold."""
    m = Model(spark, sf_dir)
    c = m.customer.select("dim_customer_id", "customer_name", "region")
    parts = [c.filter(F.col("region") == r) for r in ("NORA", "CASA", "EMEA", "APAC")]
    stacked = lk.combine(parts, "V")
    right = m.demand.select("dim_customer_id", "quantity", F.lit("x").alias("region"))
    return lk.merge_frames(stacked, right, ["dim_customer_id"], how="left", agg={"quantity": "sum"}, when="before")


query("j_merge_frames", sql("""
SELECT c.dim_customer_id, c.customer_name, c.region, CAST(q.quantity AS BIGINT) AS quantity
FROM customer c LEFT JOIN (SELECT dim_customer_id, sum(quantity) AS quantity FROM demand GROUP BY 1) q USING (dim_customer_id)
""", "customer", "demand"))(j_merge_frames)


# ------------------------------------------------------------------------------------ aggregates
def a_group_by_case(spark, sf_dir):
    """A01 GROUP BY with SUM/MAX/MIN/COUNT/AVG, A02 GROUP BY a CASE expression, A11 dict-driven."""
    d = Model(spark, sf_dir).demand
    bucket = F.when(F.col("buying_program").isin("Bulk Buy"), "bulk").when(
        F.col("buying_program").ilike("%quick turn%"), "quick turn").otherwise("out of sync")
    out = agg.aggregate(d.withColumn("program_bucket", bucket), ["program_bucket", "demand_category"],
                        {"quantity": ["sum", "max", "min", "count", "avg"], "dim_product_id": ["count_distinct"]},
                        rename={"dim_product_id_count_distinct": "n_products"})
    return out.withColumn("quantity_avg", F.round("quantity_avg", 6))


query("a_group_by_case", sql("""
SELECT CASE WHEN buying_program IN ('Bulk Buy') THEN 'bulk' WHEN buying_program ILIKE '%quick turn%' THEN 'quick turn'
            ELSE 'out of sync' END AS program_bucket, demand_category,
       CAST(sum(quantity) AS BIGINT) AS quantity_sum, max(quantity) AS quantity_max, min(quantity) AS quantity_min,
       count(quantity) AS quantity_count, round(avg(quantity), 6) AS quantity_avg,
       count(DISTINCT dim_product_id) AS n_products
FROM demand GROUP BY 1, 2""", "demand"))(a_group_by_case)


def a_any_value_having(spark, sf_dir):
    """A03 'any value' collapse with MAX over many attributes, A04 HAVING."""
    m = Model(spark, sf_dir)
    j = m.demand.join(m.product, "dim_product_id")
    per = j.groupBy("dim_product_id").agg(F.sum("quantity").alias("quantity"),
                                          *[F.max(c).alias(c) for c in ("material_id", "style_id", "construction_type",
                                                                        "style_complexity", "cat_sub_sbu")])
    return agg.having(per, F.col("quantity") > 300)


query("a_any_value_having", sql("""
SELECT dim_product_id, CAST(sum(quantity) AS BIGINT) AS quantity, max(material_id) AS material_id, max(style_id) AS style_id,
       max(construction_type) AS construction_type, max(style_complexity) AS style_complexity, max(cat_sub_sbu) AS cat_sub_sbu
FROM demand JOIN product USING (dim_product_id)
GROUP BY dim_product_id HAVING sum(quantity) > 300""", "demand", "product"))(a_any_value_having)


def a_ratio_product(spark, sf_dir):
    """A05 SUM / COUNT(DISTINCT) with integer division, A07 product of aggregates truncated to INT."""
    m = Model(spark, sf_dir)
    j = m.demand.join(m.product.select("dim_product_id", "style_id"), "dim_product_id") \
                .withColumn("pct", ((F.col("dim_factory_id_original") % 4) + 1) * 0.25) \
                .withColumn("adj", F.lit(1.1))
    a = agg.ratio_per_distinct(j, ["dim_factory_id_original"], "quantity", "style_id", "volume_per_style")
    b = agg.product_of_aggregates(j, ["dim_factory_id_original"], "quantity", "pct", "adj", "adjusted_capacity")
    return a.join(b, "dim_factory_id_original")


query("a_ratio_product", sql("""
SELECT dim_factory_id_original, CAST(sum(quantity) // count(DISTINCT style_id) AS BIGINT) AS volume_per_style,
       CAST(trunc(sum(quantity) * max(pct) * max(adj)) AS BIGINT) AS adjusted_capacity
FROM (SELECT d.*, p.style_id, ((dim_factory_id_original % 4) + 1) * 0.25 AS pct, 1.1 AS adj
      FROM demand d JOIN product p USING (dim_product_id)) j
GROUP BY 1""", "demand", "product"))(a_ratio_product)


def a_group_total(spark, sf_dir):
    """A08 write the group total back onto each row (aggregate + join, not a window)."""
    d = Model(spark, sf_dir).demand.select("order_id", "line_id", "dim_customer_id", "dim_product_id", "quantity")
    return agg.group_total(d, ["dim_customer_id", "dim_product_id"], "quantity", "customer_material_total")


query("a_group_total", sql("""
SELECT order_id, line_id, dim_customer_id, dim_product_id, quantity,
       CAST(sum(quantity) OVER (PARTITION BY dim_customer_id, dim_product_id) AS BIGINT) AS customer_material_total
FROM demand""", "demand"))(a_group_total)


def a_join_survival(spark, sf_dir):
    """A10 existence / row counts, R16 join-survival counts in one aggregate."""
    m = Model(spark, sf_dir)
    flex = m.product.filter(F.col("style_complexity") == "Flex").select("dim_product_id", F.lit(1).alias("p_ok"))
    emea = m.customer.filter(F.col("region") == "EMEA").select("dim_customer_id", F.lit(1).alias("c_ok"))
    j = m.demand.join(flex, "dim_product_id", "left").join(emea, "dim_customer_id", "left")
    return agg.counts(j, {"n_product_match": F.col("p_ok") == 1,
                          "n_product_and_customer_match": (F.col("p_ok") == 1) & (F.col("c_ok") == 1)})


query("a_join_survival", sql("""
SELECT count(*) AS n_rows,
       CAST(sum(CASE WHEN p.dim_product_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_product_match,
       CAST(sum(CASE WHEN p.dim_product_id IS NOT NULL AND c.dim_customer_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT)
           AS n_product_and_customer_match
FROM demand d
LEFT JOIN (SELECT dim_product_id FROM product WHERE style_complexity = 'Flex') p USING (dim_product_id)
LEFT JOIN (SELECT dim_customer_id FROM customer WHERE region = 'EMEA') c USING (dim_customer_id)
""", "demand", "product", "customer"))(a_join_survival)


# --------------------------------------------------------------------------------- windows / top-k
DEMAND_COLS = ["dim_release_id", "demand_category", "buying_program", "order_id", "line_id", "dim_product_id",
               "dim_customer_id", "dim_factory_id_original", "dim_date_id", "quantity", "is_edited", "line_status"]


def w_dedupe(spark, sf_dir):
    """W01 keep one row per (order, line); the kept row is the smallest by all columns."""
    d = Model(spark, sf_dir).demand.select(*DEMAND_COLS)
    return rank.dedupe(d, ["order_id", "line_id"])


_rest = [c for c in DEMAND_COLS if c not in ("order_id", "line_id")]
query("w_dedupe", sql(f"""
SELECT {', '.join(DEMAND_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, line_id ORDER BY {', '.join(c + ' NULLS FIRST' for c in _rest)}) AS rn
  FROM demand) t WHERE rn = 1""", "demand"))(w_dedupe)


def _ranked(spark, sf_dir, level):
    m = Model(spark, sf_dir)
    per = (m.demand.join(m.product.select("dim_product_id", level), "dim_product_id")
                   .groupBy(level).agg(F.sum("quantity").alias("quantity")))
    r = rank.global_rank(per, "quantity", out="rank")
    return r.withColumn("rank_label", rank.rank_label(F.col("rank"), 50, "Top 50", "Others"))


def w_rank_style(spark, sf_dir):
    """W02 global RANK() by summed quantity per style (distributed), W04 top-50 label."""
    return _ranked(spark, sf_dir, "style_id")


def w_rank_material(spark, sf_dir):
    """W03 the same ranking per material."""
    return _ranked(spark, sf_dir, "material_id")


def _rank_sql(level):
    return sql(f"""
SELECT {level}, quantity, CAST(rank AS BIGINT) AS rank,
       CASE WHEN rank BETWEEN 1 AND 50 THEN 'Top 50' ELSE 'Others' END AS rank_label
FROM (SELECT {level}, CAST(sum(quantity) AS BIGINT) AS quantity, rank() OVER (ORDER BY sum(quantity) DESC) AS rank
      FROM demand JOIN product USING (dim_product_id) GROUP BY {level}) t""", "demand", "product")


query("w_rank_style", _rank_sql("style_id"))(w_rank_style)
query("w_rank_material", _rank_sql("material_id"))(w_rank_material)


def w_top_customers(spark, sf_dir):
    """W05 TOP 10 + DENSE_RANK over an aggregate (ties broken by key), W06 TOP 5 latest."""
    d = Model(spark, sf_dir).demand
    per = d.groupBy("dim_customer_id").agg(F.sum("quantity").alias("quantity"))
    top = rank.top_n(per, [F.col("quantity").desc(), F.col("dim_customer_id").asc()], 10)
    top = rank.top_n_per_group(top.withColumn("g", F.lit(1)), ["g"], [F.col("quantity").desc(), F.col("dim_customer_id")],
                               10, "dense_rank", dense_on=[F.col("quantity").desc()]).drop("g")
    latest = rank.top_n(d.select("order_id", "dim_date_id").distinct(),
                        [F.col("dim_date_id").desc(), F.col("order_id").desc()], 5)
    return (top.select(F.lit("top_customers").alias("kind"), F.col("dim_customer_id").alias("key"), "quantity", "dense_rank")
               .unionByName(latest.select(F.lit("latest_orders").alias("kind"), F.col("order_id").alias("key"),
                                          F.col("dim_date_id").cast("bigint").alias("quantity"),
                                          F.lit(None).cast("int").alias("dense_rank"))))


query("w_top_customers", sql("""
SELECT 'top_customers' AS kind, dim_customer_id AS key, quantity, CAST(dense_rank() OVER (ORDER BY quantity DESC) AS INTEGER) AS dense_rank
FROM (SELECT dim_customer_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM demand GROUP BY 1
      ORDER BY quantity DESC, dim_customer_id LIMIT 10) t
UNION ALL
SELECT 'latest_orders', order_id, CAST(dim_date_id AS BIGINT), CAST(NULL AS INTEGER)
FROM (SELECT DISTINCT order_id, dim_date_id FROM demand ORDER BY dim_date_id DESC, order_id DESC LIMIT 5) l
""", "demand"))(w_top_customers)


def w_latest_release(spark, sf_dir):
    """W08 the latest and the previous release id."""
    return rank.latest(Model(spark, sf_dir).demand, "dim_release_id", 2)


query("w_latest_release", sql("""
SELECT DISTINCT dim_release_id FROM demand ORDER BY dim_release_id DESC LIMIT 2""", "demand"))(w_latest_release)


# ---------------------------------------------------------------------------------------- reshape
def u_union_regions(spark, sf_dir):
    """U01 UNION (distinct) of regional blocks."""
    m = Model(spark, sf_dir)
    j = m.demand.join(m.customer.select("dim_customer_id", "region"), "dim_customer_id") \
                .join(m.product.select("dim_product_id", "material_id"), "dim_product_id")
    blocks = [j.filter(F.col("region") == r).select("material_id", "region") for r in ("NORA", "CASA", "EMEA", "APAC")]
    return reshape.union_distinct(*blocks)


query("u_union_regions", sql("""
SELECT material_id, region FROM demand JOIN customer USING (dim_customer_id) JOIN product USING (dim_product_id) WHERE region = 'NORA'
UNION SELECT material_id, region FROM demand JOIN customer USING (dim_customer_id) JOIN product USING (dim_product_id) WHERE region = 'CASA'
UNION SELECT material_id, region FROM demand JOIN customer USING (dim_customer_id) JOIN product USING (dim_product_id) WHERE region = 'EMEA'
UNION SELECT material_id, region FROM demand JOIN customer USING (dim_customer_id) JOIN product USING (dim_product_id) WHERE region = 'APAC'
""", "demand", "customer", "product"))(u_union_regions)


def u_capacity_grid(spark, sf_dir):
    """U04 weekly grid -> long (UNPIVOT drops empty cells), U06 generic pivot, built from capacity."""
    m = Model(spark, sf_dir)
    cal = F.broadcast(m.calendar.select("id", "year_accounting", "week_accounting"))
    cap = m.capacity.join(cal, F.col("week_date_id") == F.col("id"))
    weeks = [f"wk{w:02d}" for w in range(1, 54)]
    grid = (cap.withColumn("wk", F.concat(F.lit("wk"), F.lpad(F.col("week_accounting").cast("string"), 2, "0")))
               .transform(lambda df: reshape.pivot_generic(df, ["dim_factory_id", "construction_type", "year_accounting"],
                                                           "wk", weeks, "capacity_available_weekly", m.parts)))
    long = reshape.unpivot_nonnull(grid, ["dim_factory_id", "construction_type", "year_accounting"], weeks, "wk", "capacity")
    return long.select("dim_factory_id", "construction_type", "year_accounting",
                       F.right("wk", F.lit(2)).cast("int").alias("week_accounting"), F.col("capacity").cast("bigint").alias("capacity"))


query("u_capacity_grid", sql("""
SELECT dim_factory_id, construction_type, year_accounting, week_accounting, CAST(sum(capacity_available_weekly) AS BIGINT) AS capacity
FROM capacity JOIN calendar ON week_date_id = id
GROUP BY ALL""", "capacity", "calendar"))(u_capacity_grid)

CATEGORIES = ["Forecast", "Need to Buy", "Order"]


def u_signal_pivot(spark, sf_dir):
    """Demand pivot by signal type (fixed columns, SUM, NULL -> 0) per region and program."""
    m = Model(spark, sf_dir)
    j = m.demand.join(m.customer.select("dim_customer_id", "region"), "dim_customer_id")
    return reshape.pivot_sum(j, ["region", "buying_program"], "demand_category", CATEGORIES, "quantity")


query("u_signal_pivot", sql("""
SELECT region, buying_program,
       CAST(coalesce(sum(CASE WHEN demand_category = 'Forecast' THEN quantity END), 0) AS BIGINT) AS "Forecast",
       CAST(coalesce(sum(CASE WHEN demand_category = 'Need to Buy' THEN quantity END), 0) AS BIGINT) AS "Need to Buy",
       CAST(coalesce(sum(CASE WHEN demand_category = 'Order' THEN quantity END), 0) AS BIGINT) AS "Order"
FROM demand JOIN customer USING (dim_customer_id) GROUP BY 1, 2""", "demand", "customer"))(u_signal_pivot)


def u_text_pivot_unpivot(spark, sf_dir):
    """U06 pivot of a text measure (MAX), U07 generic unpivot keeping NULLs with prefix removal,
    U02 membership test."""
    m = Model(spark, sf_dir)
    j = m.demand.join(m.customer.select("dim_customer_id", "region", "sold_to_party"), "dim_customer_id") \
                .withColumn("status", F.concat(F.lit("last_party_"), F.col("line_status")))
    wide = reshape.pivot_generic(j, ["region", "demand_category"], "status", ["last_party_O", "last_party_F", "last_party_X"],
                                 "sold_to_party")
    long = reshape.unpivot_keep(wide, ["region", "demand_category"], ["last_party_O", "last_party_F", "last_party_X"],
                                "line_status", "party", prefix="last_party_")
    return reshape.membership(long, "party", ["party"], "has_party")


query("u_text_pivot_unpivot", sql("""
SELECT region, demand_category, s.line_status, party, party IS NOT NULL AS has_party
FROM (SELECT region, demand_category FROM demand JOIN customer USING (dim_customer_id) GROUP BY 1, 2) g
CROSS JOIN (VALUES ('O'), ('F'), ('X')) s(line_status)
LEFT JOIN (SELECT region, demand_category, line_status, max(sold_to_party) AS party
           FROM demand JOIN customer USING (dim_customer_id) GROUP BY 1, 2, 3) p USING (region, demand_category, line_status)
""", "demand", "customer"))(u_text_pivot_unpivot)
