"""Query of the ERP order extract (S08, L20) over ERP-shaped views of the orders tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import erp
from .model import Model
from .model_sql import sql
from .registry import query

RUN_DATE = "2000-03-15"
#: Test binding of the business's product groups.
PRODUCT_GROUPS = ["50 FOOTWEAR", "503", "503 FOOTWEAR", "508", "508 SNOW", "SNOW"]


def erp_tables(m: Model):
    """(header, line, shipped, shipment, shipmast, scale): orders as headers, line items as lines, those with line status F
    as shipped -- every fifth in two shipments -- suppliers as shipments, customers as stores, part sizes as scales."""
    def text(prefix, col):
        return F.concat(F.lit(prefix), col.cast("string"))

    def pick(names, col):
        return F.element_at(F.array(*(F.lit(n) for n in names)), (col % len(names) + 1).cast("int"))

    k, c = F.col("o_orderkey"), F.col("o_custkey")
    style, season, store = text("ST", c % 40), text("S", F.year("o_orderdate")), F.when(c % 19 == 0, "DPNS").when(c % 23 != 0, text("W", c))
    orders = m.table("orders")
    header = orders.select(
        k.alias("id_cut"), season.alias("season"), style.alias("style"), text("L", k).alias("lot"), F.date_add(F.to_date("o_orderdate"), 20).alias("revdd"),
        F.to_date("o_orderdate").alias("plan_date"), pick([*PRODUCT_GROUPS, "OTHER"], k).alias("misc1"),
        F.when(k % 11 == 0, "DIRECT BRAZIL").when(k % 13 != 0, F.col("o_orderpriority")).alias("misc6"), text(" d", k % 3).alias("misc18"), text("sys", k % 2).alias("misc21"),
        pick([*erp.ORDER_TYPES[:8], "XX"], k).alias("misc25"), text("so", k).alias("misc27"), text("sla", k % 4).alias("misc41"), store.alias("store_no"),
        text("po", k).alias("ship_no"), text("  F", c % 30).alias("rfactory"), F.concat(text("V", c % 30), F.lit("  ")).alias("rdacode"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(k % 5).alias("qtyship"), (k % 3 == 0).cast("int").alias("done"),
        F.when(k % 17 == 0, "CANCELED").when(k % 29 != 0, "OPEN").alias("polocation"))
    li = m.table("lineitem")
    size, color, dimension = (F.col("l_partkey") % 50 + 1).cast("string"), text("C", F.col("l_suppkey") % 7), F.col("l_linenumber").cast("string")
    line = li.select(F.col("l_orderkey").alias("id_cut"), size.alias("size"), color.alias("color"), dimension.alias("dimension"),
                     F.when(F.col("l_orderkey") % 31 == 0, 0).otherwise(F.col("l_quantity").cast("bigint")).alias("qty"))
    done = li.filter("l_linestatus = 'F'").join(orders, li["l_orderkey"] == orders["o_orderkey"])
    parts = F.when(F.col("l_partkey") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    shipped = done.withColumn("part", F.explode(parts)).select(
        season.alias("season"), style.alias("style"), text("L", F.col("l_orderkey")).alias("cut"), size.alias("size"), color.alias("color"), dimension.alias("dimension"),
        text("N", F.col("l_suppkey") + F.col("part")).alias("shipment"), (F.col("l_quantity").cast("bigint") - F.col("part")).alias("unitship"),
        F.to_date("l_shipdate").alias("shipdate"), F.date_add(F.to_date("l_shipdate"), 3).alias("actual_crd_dt"))
    s = F.col("s_suppkey")
    shipment = m.table("supplier").select(text("N", s).alias("shipment"), (s % 2).cast("int").alias("closed"), F.date_add(F.lit("1996-01-01").cast("date"), s.cast("int")).alias("firstclosedon"))
    shipmast = m.table("customer").select(text("W", F.col("c_custkey")).alias("shipno"), F.concat(F.lit(" "), "c_name").alias("shipname"))
    scale = m.table("part").groupBy(F.col("p_size").cast("string").alias("scale")).agg(
        F.max(F.when(F.col("p_size") % 9 == 0, "n/a").otherwise((F.col("p_size") % 4).cast("string"))).alias("desce"))
    return header, line, shipped, shipment, shipmast, scale


def l20_order_extract(spark, sf_dir):
    """The order delta of the month before the run date and later, from six ERP tables."""
    return erp.extract_orders(*erp_tables(Model(spark, sf_dir)), F.lit(RUN_DATE).cast("date"), PRODUCT_GROUPS)


def _list(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


query("l20_order_extract", sql(f"""
WITH h AS (
  SELECT *, o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS od, 'ST' || o_custkey % 40 AS style, 'S' || year(o_orderdate) AS season,
         CASE WHEN o_custkey % 19 = 0 THEN 'DPNS' WHEN o_custkey % 23 <> 0 THEN 'W' || o_custkey END AS store_no,
         ({PRODUCT_GROUPS + ['OTHER']})[o_orderkey % 7 + 1] AS misc1, ({list(erp.ORDER_TYPES[:8]) + ['XX']})[o_orderkey % 9 + 1] AS misc25,
         CASE WHEN o_orderkey % 11 = 0 THEN 'DIRECT BRAZIL' WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS misc6,
         CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_orderkey % 5 END AS qtyship, CAST(o_orderkey % 3 = 0 AS INTEGER) AS done,
         CASE WHEN o_orderkey % 17 = 0 THEN 'CANCELED' WHEN o_orderkey % 29 <> 0 THEN 'OPEN' END AS polocation FROM orders),
n AS (SELECT *, CAST(l_partkey % 50 + 1 AS VARCHAR) AS size, 'C' || l_suppkey % 7 AS color, CAST(l_linenumber AS VARCHAR) AS dimension,
             CASE WHEN l_orderkey % 31 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS qty FROM lineitem),
s AS (SELECT n.*, h.season, h.style, part, 'N' || (l_suppkey + part) AS shipment, CAST(l_quantity AS BIGINT) - part AS unitship
      FROM n JOIN h ON n.l_orderkey = h.k JOIN (VALUES (1), (2)) p(part) ON part = 1 OR l_partkey % 5 = 0 WHERE l_linestatus = 'F'),
f AS (SELECT CAST(p_size AS VARCHAR) AS scale, max(CASE WHEN p_size % 9 = 0 THEN 0 ELSE p_size % 4 END) AS factor FROM part GROUP BY 1)
SELECT 'V' || c % 30 AS dim_factory_vendor_code, 'F' || c % 30 AS dim_factory_factory_code, 'L' || k AS po_code_cut, misc1 AS dim_product_sbu, n.size AS dim_product_size,
       n.color AS dim_product_color_description, n.dimension, misc6 AS source, h.style AS dim_product_style_id, 'po' || k AS po_code, misc25 AS po_type, 'sla' || k % 4 AS vf_sla,
       store_no AS dim_customer_dc_code_brio, 'd' || k % 3 AS delay_reason, s.shipment AS shipment_id, 'sys' || k % 2 AS source_system, c_name AS dc_name, 'so' || k AS sales_order,
       od AS po_issue_dt, CAST(s_suppkey % 2 AS INTEGER) AS shipment_status, n.qty AS order_qty, s.unitship AS shipped_qty, CAST(s.l_shipdate AS DATE) + 3 AS actual_crd_dt,
       od + 20 AS revised_crd_dt, CAST(s.l_shipdate AS DATE) AS shipped_dt, CAST(n.qty * CASE WHEN coalesce(factor, 0) = 0 THEN 1 ELSE factor END AS BIGINT) AS lum_order_qty,
       CAST(s.unitship * CASE WHEN coalesce(factor, 0) = 0 THEN 1 ELSE factor END AS BIGINT) AS lum_shipped_qty, DATE '1996-01-01' + CAST(s_suppkey AS INTEGER) AS shipment_closed_on_dt,
       done AS is_po_completed
FROM h LEFT JOIN n ON h.k = n.l_orderkey
LEFT JOIN s ON s.season = h.season AND s.style = h.style AND s.l_orderkey = h.k AND s.color = n.color AND s.size = n.size AND s.dimension = n.dimension
LEFT JOIN supplier ON s.shipment = 'N' || s_suppkey
LEFT JOIN customer ON store_no = 'W' || c_custkey
LEFT JOIN f ON n.size = f.scale
WHERE od + 20 >= DATE '{RUN_DATE}' - INTERVAL 1 MONTH AND misc6 NOT IN ('DIRECT BRAZIL') AND misc1 IN {_list(PRODUCT_GROUPS)} AND NOT (qtyship = 0 AND done = 1)
  AND NOT (n.qty = 0) AND polocation <> 'CANCELED' AND misc25 IN {_list(erp.ORDER_TYPES)} AND store_no NOT IN {_list(erp.OTHER_STORES)}"""))(l20_order_extract)
