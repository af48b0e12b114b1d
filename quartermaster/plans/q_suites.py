"""Validation suites of the regional need-to-buy loads (V10) and of the order extract (V12), each source in one pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import safe_date
from ..operators.validate import Check, suite_findings, suite_values
from .model import Model
from .model_sql import sql
from .registry import query

SOURCES = {"EMEA": "EMEA need-to-buy", "APAC": "APAC need-to-buy", "CASA": "CASA need-to-buy", "NORA": "NORA need-to-buy"}
ORDERS = "Order extract"
MATERIAL, PRIORITY = "Material ID not in master data", "Material ID not in priority list"
CUSTOMER, FACTORY, DATE = "Customer not in master data", "Factory short name not in master data", "XFD is not a valid date"


def _pair(a, b):
    """Both parts as one key, NULL if either is."""
    return F.concat(a, F.lit("|"), b)


def v10_load_suites(spark, sf_dir):
    """V10 the suites of the four need-to-buy loads (EMEA has no date check), V12 that of the orders: one pass over the loads
    of all regions, one over the orders, one join with the master data."""
    m = Model(spark, sf_dir)
    k, n = F.col("order_id"), F.col("line_id")
    materials = m.product.select("dim_product_id", "material_id").hint("shuffle_hash")  # lines are not sorted to meet them
    rows = (m.demand_with(m.customer.select("dim_customer_id", "region", "customer_name"))  # without a customer no region, so no suite
             .join(materials, "dim_product_id"))
    cut = F.substring(F.when(k % 37 == 0, "VN??").when(k % 41 != 0, F.concat("material_id", F.lit("-old"))), 1, 10)
    size = F.when(k % 13 != 0, n.cast("string"))
    customer = F.when(k % 43 == 0, F.concat(F.lit("OLD"), F.col("dim_customer_id") % 7)).when(k % 47 != 0, F.col("customer_name"))
    code = F.when(k % 10 == 0, F.concat(F.lit("FX"), F.col("dim_factory_id_original") % 9)).when(k % 11 != 0, F.concat(F.lit("F"), F.col("dim_factory_id_original") * 3 % 140))
    day = F.when(k % 53 == 0, F.concat(F.lit("day "), k % 5)).when(k % 59 != 0, F.date_format("demand_date", "yyyy-MM-dd"))
    common = [Check(CUSTOMER, customer, customer, "customer"), Check(MATERIAL, cut, _pair(cut, size), "product"), Check(PRIORITY, cut, cut, "priority"),
              Check(FACTORY, code, code, "factory")]
    dated = [*common, Check(DATE, day, broken=lambda x: safe_date(x).isNull())]
    source = F.element_at(F.create_map(*[F.lit(x) for kv in SOURCES.items() for x in kv]), F.col("region"))
    loads = suite_values(rows, source, {SOURCES["EMEA"]: common, **{SOURCES[r]: dated for r in ("APAC", "CASA", "NORA")}})

    lines = m.lines.join(materials, "dim_product_id")
    style = F.replace(F.concat(F.substring("material_id", 1, 4), F.lit(" "), F.substring("material_id", 5, 6)), F.lit(" "), F.lit(""))
    own_size = F.coalesce(F.trim(F.when(k % 17 != 0, F.concat(F.lit(" "), n.cast("string")))), F.lit(""))
    own_code = F.replace(F.concat(F.lit(" F"), F.col("dim_factory_id_original") * 5 % 160), F.lit(" "), F.lit(""))
    orders = suite_values(lines, F.lit(ORDERS), {ORDERS: [
        Check(MATERIAL, F.concat(F.coalesce(style, F.lit("")), F.lit("/"), own_size), _pair(style, own_size), "product"),
        Check(FACTORY, own_code, own_code, "factory")]})

    material = F.substring("material_id", 1, 10).alias("material_id")
    sized = m.product.filter("dim_product_id % 5 <> 0").select(F.explode(F.array(*[_pair(material, F.lit(str(i))) for i in range(1, 5)])).alias("key"))
    mapped = [F.lit(f"FX{i}") for i in range(0, 9, 2)]
    references = {
        "customer": m.customer.select("customer_name").union(m.customer.select(F.concat(F.lit("OLD"), F.col("dim_customer_id") % 3))),
        "product": sized, "priority": m.product.filter("dim_product_id % 17 <> 3").select(material),
        "factory": m.factory.select(F.concat(F.lit("F"), "dim_factory_id")).union(m.factory.select(F.explode(F.array(*mapped))))}
    return suite_findings([loads, orders], references, "DEMAND")


_LOCAL = (
    ("s", """SELECT region || ' need-to-buy' AS source, region, order_id AS k,
         substr(CASE WHEN order_id % 37 = 0 THEN 'VN??' WHEN order_id % 41 <> 0 THEN material_id || '-old' END, 1, 10) AS mtl,
         CASE WHEN order_id % 13 <> 0 THEN CAST(line_id AS VARCHAR) END AS size,
         CASE WHEN order_id % 43 = 0 THEN 'OLD' || dim_customer_id % 7 WHEN order_id % 47 <> 0 THEN customer_name END AS cust,
         CASE WHEN order_id % 10 = 0 THEN 'FX' || dim_factory_id_original % 9 WHEN order_id % 11 <> 0 THEN 'F' || dim_factory_id_original * 3 % 140 END AS code,
         CASE WHEN order_id % 53 = 0 THEN 'day ' || order_id % 5 WHEN order_id % 59 <> 0 THEN strftime(demand_date, '%Y-%m-%d') END AS day
  FROM demand JOIN customer USING (dim_customer_id) JOIN product USING (dim_product_id)"""),
    ("known", """SELECT substr(material_id, 1, 10) AS mtl, CAST(n AS VARCHAR) AS size FROM product, range(1, 5) t(n) WHERE dim_product_id % 5 <> 0"""),
    ("prio", """SELECT substr(material_id, 1, 10) AS mtl FROM product WHERE dim_product_id % 17 <> 3"""),
    ("names", """SELECT customer_name AS name FROM customer UNION SELECT 'OLD' || dim_customer_id % 3 FROM customer"""),
    ("codes", """SELECT 'F' || dim_factory_id AS code FROM factory UNION SELECT 'FX' || n FROM range(0, 9, 2) t(n)"""),
    ("o", """SELECT substr(material_id, 1, 10) AS mtl, CASE WHEN l_orderkey % 17 <> 0 THEN CAST(l_linenumber AS VARCHAR) ELSE '' END AS size, 'F' || l_suppkey * 5 % 160 AS code
      FROM lineitem JOIN product ON dim_product_id = l_partkey"""),
)
query("v10_load_suites", sql(f"""
SELECT DISTINCT 'DEMAND' AS system, source, category, coalesce(value, '') AS value FROM (
  SELECT source, '{CUSTOMER}' AS category, cust AS value FROM s WHERE NOT EXISTS (SELECT 1 FROM names WHERE name = cust)
  UNION ALL SELECT source, '{MATERIAL}', mtl FROM s WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.mtl = s.mtl AND known.size = s.size)
  UNION ALL SELECT source, '{PRIORITY}', mtl FROM s WHERE NOT EXISTS (SELECT 1 FROM prio WHERE prio.mtl = s.mtl)
  UNION ALL SELECT source, '{FACTORY}', code FROM s WHERE NOT EXISTS (SELECT 1 FROM codes WHERE codes.code = s.code)
  UNION ALL SELECT source, '{DATE}', day FROM s WHERE region <> 'EMEA' AND try_cast(day AS DATE) IS NULL
  UNION ALL SELECT '{ORDERS}', '{MATERIAL}', mtl || '/' || size FROM o WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.mtl = o.mtl AND known.size = o.size)
  UNION ALL SELECT '{ORDERS}', '{FACTORY}', code FROM o WHERE NOT EXISTS (SELECT 1 FROM codes WHERE codes.code = o.code)) x""",
    "demand", "customer", "product", "factory", local=_LOCAL))(v10_load_suites)
