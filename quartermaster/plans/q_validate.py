"""Queries for validation (V*) and merges (M*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import merge, validate
from .model import Model
from .model_sql import pad, sql
from .registry import query

CONSTRUCTION_TYPES = ["STANDARD", "MEDIUM", "ECONOMY", "PROMO", "LARGE"]


def v_validation_suite(spark, sf_dir):
    """V01/V02 customer text missing in master data and mapping, V03 composite material/size keys,
    V05 invalid dates, V06 construction type outside the fixed list, V10 the suite as a union."""
    m = Model(spark, sf_dir)
    o = m.table("orders")
    k = F.col("o_orderkey")
    staged = o.select(
        F.when(k % 9 == 0, F.lit(None)).when(k % 4 == 0, F.concat(F.lit("Customer#"), text.pad_key("o_custkey", 9)))
         .when(k % 4 == 1, F.concat(F.lit("OLD"), F.col("o_custkey").cast("string")))
         .otherwise(F.concat(F.lit("UNKNOWN"), F.col("o_custkey").cast("string"))).alias("customer_text"),
        F.when(k % 7 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("buy_dt"))
    cust = m.table("customer")
    mapping = cust.filter(F.col("c_custkey") % 10 == 0).select(
        F.lit("Customer Master").alias("category"), F.col("c_name").alias("parent"),
        F.concat(F.lit("OLD"), F.col("c_custkey").cast("string")).alias("child"))
    sized = m.demand.join(m.product.select("dim_product_id", "material_id"), "dim_product_id") \
                    .select("material_id", F.when(F.col("line_id") != 6, F.col("line_id")).cast("string").alias("size"))
    dim_sizes = sized.filter(F.col("size").isin("1", "2", "3", "4")).distinct()
    return validate.run_suite([
        validate.missing_in(staged, ["customer_text"], cust, ["c_name"], "NTB", "Customer missing",
                            mapping=mapping, mapping_category="Customer Master"),
        validate.missing_in(sized, ["material_id", "size"], dim_sizes, ["material_id", "size"], "NTB", "Material/size missing"),
        validate.invalid_dates(staged, "buy_dt", "NTB"),
        validate.not_in_list(m.product, "construction_type", CONSTRUCTION_TYPES, "Priority list", "Construction type invalid"),
    ], system="DEMAND")


query("v_validation_suite", sql(f"""
SELECT DISTINCT * FROM (
  SELECT 'DEMAND' AS system, 'NTB' AS source, 'Customer missing' AS category, coalesce(t, '') AS value
  FROM (SELECT DISTINCT CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'Customer#' || ({pad('o_custkey', 9)})
                             WHEN o_orderkey % 4 = 1 THEN 'OLD' || CAST(o_custkey AS VARCHAR)
                             ELSE 'UNKNOWN' || CAST(o_custkey AS VARCHAR) END AS t FROM orders) s
  WHERE t IS NULL OR (t NOT IN (SELECT c_name FROM customer)
    AND t NOT IN (SELECT 'OLD' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 10 = 0))
  UNION ALL
  SELECT 'DEMAND', 'NTB', 'Material/size missing', material_id || '/' || coalesce(size, '')
  FROM (SELECT DISTINCT p.material_id, CASE WHEN d.line_id <> 6 THEN CAST(d.line_id AS VARCHAR) END AS size FROM demand d JOIN product p USING (dim_product_id)) x
  WHERE size IS NULL OR size NOT IN ('1', '2', '3', '4')
  UNION ALL
  SELECT 'DEMAND', 'NTB', 'Invalid date', 'not a date' FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL
  SELECT 'DEMAND', 'Priority list', 'Construction type invalid', construction_type FROM product
  WHERE construction_type NOT IN ({', '.join(repr(c) for c in CONSTRUCTION_TYPES)})
) u""", "demand", "product"))(v_validation_suite)


def m_merge_orders(spark, sf_dir):
    """M02 three-way merge on a null-safe key (J17): orders of the old extract vs the new one; a fifth of the
    customer numbers of the composite key and some new amounts are NULL."""
    o = Model(spark, sf_dir).table("orders")
    k = F.col("o_orderkey")
    cust = F.when(k % 5 != 0, F.col("o_custkey")).alias("cust")
    target = o.filter(k % 3 != 2).select("o_orderkey", cust, F.round("o_totalprice", 2).alias("amount"), F.lit("old note").alias("note"))
    source = o.filter(k % 3 != 0).select("o_orderkey", cust, F.when(k % 7 != 0, F.round(F.col("o_totalprice") * 2, 2)).alias("amount"),
                                         F.lit("new note").alias("note"))
    merged = merge.merge3(target, source, ["o_orderkey", "cust"], ["amount"])
    return merged.groupBy("action", "note", F.col("cust").isNull().alias("no_customer")).agg(
        F.count(F.lit(1)).alias("n"), F.count("amount").alias("n_amounts"), F.round(F.sum("amount"), 2).alias("amount"))


query("m_merge_orders", sql("""
SELECT CASE WHEN o_orderkey % 3 = 1 THEN 'update' ELSE 'insert' END AS action,
       CASE WHEN o_orderkey % 3 = 1 THEN 'old note' END AS note,
       o_orderkey % 5 = 0 AS no_customer, count(*) AS n, count(CASE WHEN o_orderkey % 7 <> 0 THEN 1 END) AS n_amounts,
       round(sum(CASE WHEN o_orderkey % 7 <> 0 THEN round(o_totalprice * 2, 2) END), 2) AS amount
FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2, 3"""))(m_merge_orders)


def m_override_factory(spark, sf_dir):
    """M03 update-from-join with a de-duplicated source, M04 reset of a slice, M01 upsert."""
    d = Model(spark, sf_dir).demand.select("order_id", "line_id", "dim_factory_id_original", "is_edited", "quantity")
    report = d.filter(F.col("line_id") == 1).select("order_id", (F.col("dim_factory_id_original") + 1000).alias("dim_factory_id_original"))
    updated = merge.update_from(d, report, ["order_id"], ["dim_factory_id_original"])
    reset = merge.reset(updated, F.col("is_edited") == 1, {"dim_factory_id_original": -1})
    per_order = reset.groupBy("order_id").agg(F.max("dim_factory_id_original").alias("factory"), F.sum("quantity").alias("quantity"))
    extra = Model(spark, sf_dir).table("orders").filter(F.col("o_orderkey") % 5 == 0).select(
        F.col("o_orderkey").alias("order_id"), F.when(F.col("o_orderkey") % 3 != 0, -2).cast("bigint").alias("factory"), F.lit(0).cast("bigint").alias("quantity"))
    return merge.upsert(per_order, extra, ["order_id"])


query("m_override_factory", sql("""
SELECT coalesce(e.order_id, p.order_id) AS order_id, CASE WHEN e.order_id IS NOT NULL THEN e.factory ELSE p.factory END AS factory,
       CASE WHEN e.order_id IS NOT NULL THEN e.quantity ELSE p.quantity END AS quantity
FROM (SELECT order_id, max(f) AS factory, CAST(sum(quantity) AS BIGINT) AS quantity
      FROM (SELECT d.order_id, d.quantity,
                   CASE WHEN d.is_edited = 1 THEN -1 WHEN r.nf IS NOT NULL THEN r.nf ELSE d.dim_factory_id_original END AS f
            FROM demand d LEFT JOIN (SELECT order_id, max(dim_factory_id_original + 1000) AS nf FROM demand WHERE line_id = 1 GROUP BY 1) r
              USING (order_id)) x GROUP BY order_id) p
FULL OUTER JOIN (SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(-2 AS BIGINT) END AS factory, CAST(0 AS BIGINT) AS quantity
                 FROM orders WHERE o_orderkey % 5 = 0) e ON e.order_id = p.order_id""", "demand"))(m_override_factory)
