"""Queries for the product dimension (D10-D16) and releases."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import products, releases
from ..session import ensure_checkpoint_dir
from .model import Model
from .model_sql import sql
from .registry import query

DIM = ["material_id", "size", "style_id", "color", "style_name", "gender", "lifecycle", "style_complexity", "construction_type", "cat_sub_sbu",
       "product_type", "qt_mtl", "clk_mtl", "sjd_mtl", "dtp_mtl", "description_erp", "is_placeholder", "placeholder_level"]


def _inputs(m):
    """The dimension as it is (four fifths of the materials, size '1'), the priority list and the ERP and need-to-buy rows."""
    p, k = m.product, F.col("dim_product_id")
    none = F.lit(None).cast("string")
    text = {"color": F.concat(F.lit("c"), (k % 9).cast("string")), "lifecycle": F.when(k % 6 == 0, "Dropped").otherwise("Active"),
            "gender": F.when(k % 10 == 0, "PLACEHOLDER").when(k % 4 == 1, "M").when(k % 4 == 2, "W")}
    flag = {f: F.when(k % n == 0, "x").when(k % n == 1, "-") for f, n in (("qt_mtl", 3), ("clk_mtl", 7), ("sjd_mtl", 13), ("dtp_mtl", 11))}
    base = p.withColumns(text)
    dim = base.filter(k % 5 != 0).withColumns({**{f: F.lit(None).cast("int") for f in products.FLAGS}, "size": F.lit("1"), "product_type": none,
                                               "description_erp": none, "is_placeholder": F.lit(0), "placeholder_level": none}).select(*DIM)
    kind = F.when(k % 8 == 0, F.lower("construction_type")).when(k % 8 == 1, "unknown").otherwise(F.col("construction_type"))
    prio = base.filter(k % 3 != 1).withColumns(flag).withColumn("style_complexity", F.upper("style_complexity")).select(
        "material_id", "color", "style_name", "gender", "lifecycle", "style_complexity", kind.alias("construction_type"), "cat_sub_sbu", *products.FLAGS)
    types = p.select(F.col("construction_type").alias("name")).distinct()
    mapping = types.select(F.lit("Construction Type Master").alias("category"), F.col("name").alias("parent"), F.lower("name").alias("child"))
    li = m.lines.join(p.select("dim_product_id", "material_id"), "dim_product_id")
    size = F.when(F.col("line_id") != 5, F.concat(F.lit(" "), F.col("line_id").cast("string")))
    erp = li.select(F.concat(F.substring("material_id", 1, 4), F.lit(" "), F.substring("material_id", 5, 100)).alias("material_id"), size.alias("size"),
                    F.concat(F.lit("o"), (F.col("order_id") % 50).cast("string")).alias("color"), "line_id", "order_id", "quantity")
    ntb = li.filter("quantity > 40").select("material_id", (F.col("line_id") + 10).cast("string").alias("size"), "order_id")
    return dim, prio, types, mapping, erp, ntb


def d10_products(spark, sf_dir):
    """Inserts from the priority list, ERP orders and need-to-buy sizes, updates, ERP texts, the placeholder chain
    and the derived texts, as one product dimension."""
    dim, prio, types, mapping, erp, ntb = _inputs(Model(spark, sf_dir))
    ensure_checkpoint_dir(spark)  # every step reads the dimension twice, so each is cut: the plan stays linear
    dim = dim.unionByName(products.new_from_priority(dim, prio)).checkpoint()
    dim = dim.unionByName(products.new_from_orders(dim, erp.select("material_id", "size", "color"))).checkpoint()
    dim = dim.unionByName(products.new_sizes(dim, [ntb.filter("order_id % 2 = 0"), ntb.filter("order_id % 2 = 1")])).checkpoint()
    dim = products.update_from_priority(dim, prio, types, mapping)
    texts = ntb.select("material_id", "size", F.concat(F.lit("erp "), (F.col("order_id") % 20).cast("string")).alias("description_erp"))
    dim = products.update_erp_texts(dim, texts, ["description_erp"]).checkpoint()
    dim = products.derived_texts(products.placeholder_chain(dim))
    out = dim.groupBy("is_placeholder", "placeholder_level", "lifecycle", "product_type", "qt_mtl", "construction_type")
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("material_id").alias("n_materials"), F.min("size").alias("min_size"), F.max("size").alias("max_size"),
                   F.max("style_id").alias("max_style"), F.max("color").alias("max_color"), F.max("style_complexity").alias("max_complexity"),
                   F.sum("clk_mtl").alias("clk"), F.max("description_erp").alias("max_erp"), F.max("gender_new").alias("gender_new"),
                   F.max("style_name_new").alias("style_name_new"), F.max("style_id_erp").alias("style_id_erp"))


_D_LOCAL = (
    ("base", """SELECT *, 'c' || CAST(dim_product_id % 9 AS VARCHAR) AS color, CASE WHEN dim_product_id % 6 = 0 THEN 'Dropped' ELSE 'Active' END AS lifecycle,
                CASE WHEN dim_product_id % 10 = 0 THEN 'PLACEHOLDER' WHEN dim_product_id % 4 = 1 THEN 'M' WHEN dim_product_id % 4 = 2 THEN 'W' END AS gender FROM product"""),
    ("prio", """SELECT material_id, color, style_name, gender, lifecycle, upper(style_complexity) AS style_complexity, construction_type, dim_product_id AS k,
                CAST(dim_product_id % 3 = 0 AS INTEGER) AS qt, CAST(dim_product_id % 7 = 0 AS INTEGER) AS clk,
                CASE WHEN lower(cat_sub_sbu) LIKE '%vault%' THEN 'Vault' WHEN lower(cat_sub_sbu) LIKE '%arcad%' THEN 'ArcAd' ELSE 'Regular' END AS product_type
                FROM base WHERE dim_product_id % 3 <> 1"""),
    # d0: as it is; d1: plus D10; d2: plus D11; d3: plus D12
    ("d0", """SELECT material_id, '1' AS size, style_id, color, style_name, gender, lifecycle, style_complexity, construction_type,
              CAST(NULL AS INTEGER) AS qt, CAST(NULL AS INTEGER) AS clk, 0 AS ph, CAST(NULL AS VARCHAR) AS lvl FROM base WHERE dim_product_id % 5 <> 0"""),
    ("d1", """SELECT * FROM d0 UNION ALL SELECT material_id, material_id, material_id, color, style_name, gender, lifecycle, style_complexity,
              CASE WHEN k % 8 = 0 THEN lower(construction_type) WHEN k % 8 = 1 THEN 'unknown' ELSE construction_type END, qt, clk, 1, 'material_id'
              FROM prio WHERE k % 5 = 0"""),
    ("erp", """SELECT material_id, size, max(color) AS color FROM (SELECT p.material_id,
                 CASE WHEN l_linenumber <> 5 THEN CAST(l_linenumber AS VARCHAR) ELSE '' END AS size, 'o' || CAST(l_orderkey % 50 AS VARCHAR) AS color
               FROM lineitem JOIN product p ON p.dim_product_id = l_partkey) e GROUP BY 1, 2"""),
    ("d2", """SELECT * FROM d1 UNION ALL SELECT material_id, size, material_id, color, NULL, NULL, 'Active', 'N/A', NULL, NULL, NULL, 0, NULL
              FROM erp WHERE (material_id, size) NOT IN (SELECT (material_id, size) FROM d1)"""),
    ("ntb", """SELECT substr(p.material_id, 1, 11) AS material_id, CAST(l_linenumber + 10 AS VARCHAR) AS size, max('erp ' || CAST(l_orderkey % 20 AS VARCHAR)) AS erp
               FROM lineitem JOIN product p ON p.dim_product_id = l_partkey WHERE CAST(l_quantity AS BIGINT) > 40 GROUP BY 1, 2"""),
    ("d3", """SELECT * FROM d2 UNION ALL SELECT n.material_id, n.size, a.style_id, a.color, a.style_name, a.gender, a.lifecycle, a.style_complexity, a.construction_type, a.qt, a.clk, 0, NULL
              FROM ntb n JOIN (SELECT material_id, max(style_id) AS style_id, max(color) AS color, max(style_name) AS style_name, max(gender) AS gender, max(lifecycle) AS lifecycle,
                               max(style_complexity) AS style_complexity, max(construction_type) AS construction_type, max(qt) AS qt, max(clk) AS clk FROM d2 GROUP BY 1) a USING (material_id)
              WHERE (n.material_id, n.size) NOT IN (SELECT (material_id, size) FROM d2)"""),
    # D13 leaves out the unknown construction types; D14 texts
    ("d5", """SELECT d.material_id, d.size, d.style_id, coalesce(p.color, d.color) AS color, coalesce(p.style_name, d.style_name) AS style_name, d.gender,
              coalesce(p.lifecycle, d.lifecycle) AS lifecycle, coalesce(p.style_complexity, d.style_complexity) AS style_complexity,
              coalesce(p.construction_type, d.construction_type) AS construction_type, coalesce(p.qt, d.qt) AS qt, coalesce(p.clk, d.clk) AS clk, p.product_type, n.erp, d.ph, d.lvl
              FROM d3 d LEFT JOIN (SELECT * FROM prio WHERE k % 8 <> 1) p USING (material_id) LEFT JOIN ntb n ON n.material_id = d.material_id AND n.size = d.size"""),
    ("chain", """SELECT * FROM d5
      UNION ALL SELECT material_id, material_id, max(style_id), max(color), max(style_name), max(gender), max(lifecycle), max(style_complexity), max(construction_type), NULL, NULL, NULL, NULL, 1, 'material_id'
        FROM d5 WHERE ph = 0 AND material_id NOT IN (SELECT material_id FROM d5 WHERE lvl = 'material_id') GROUP BY 1
      UNION ALL SELECT style_id, style_id, style_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 1, 'style_id' FROM d5 WHERE ph = 0 AND style_id IS NOT NULL GROUP BY style_id
      UNION ALL SELECT style_complexity, style_complexity, NULL, NULL, NULL, NULL, NULL, style_complexity, NULL, NULL, NULL, NULL, NULL, 1, 'style_complexity' FROM d5 WHERE ph = 0 AND style_complexity IS NOT NULL GROUP BY style_complexity
      UNION ALL SELECT construction_type, construction_type, NULL, NULL, NULL, NULL, NULL, NULL, construction_type, NULL, NULL, NULL, NULL, 1, 'construction_type' FROM d5 WHERE ph = 0 AND construction_type IS NOT NULL GROUP BY construction_type
      UNION ALL SELECT gender, gender, NULL, NULL, NULL, gender, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 1, 'gender' FROM d5 WHERE ph = 0 AND gender <> 'PLACEHOLDER' GROUP BY gender"""),
)
query("d10_products", sql("""
SELECT ph AS is_placeholder, lvl AS placeholder_level, lifecycle, product_type, qt AS qt_mtl, construction_type, count(*) AS n,
       count(DISTINCT material_id) AS n_materials, min(size) AS min_size, max(size) AS max_size, max(style_id) AS max_style, max(color) AS max_color,
       max(style_complexity) AS max_complexity, CAST(sum(clk) AS BIGINT) AS clk, max(erp) AS max_erp,
       max(left(coalesce(style_name, ''), 2)) AS gender_new, max(CASE WHEN style_name <> '' THEN substr(style_name, 4) END) AS style_name_new,
       max(left(material_id, 8)) AS style_id_erp
FROM chain GROUP BY 1, 2, 3, 4, 5, 6""", "product", local=_D_LOCAL))(d10_products)


def p36_release_names(spark, sf_dir):
    """P36/L61 the next release name of every order day, where releases of that day exist by its customers' numbers."""
    o = Model(spark, sf_dir).table("orders")
    base = F.concat(F.lit("Release "), F.date_format("o_orderdate", "yyyyMMdd"))
    suffix = F.element_at(F.array(F.lit(""), F.lit("-1"), F.lit("-2"), F.lit(" draft")), (F.col("o_custkey") % 4 + 1).cast("int"))
    return releases.next_name(o.select(F.concat(base, suffix).alias("name")), o.select(base.alias("base")).distinct())


query("p36_release_names", sql("""
SELECT base, CASE WHEN h0 + h1 + h2 = 3 THEN NULL WHEN h1 = 1 THEN base || '-2' WHEN h0 = 1 THEN base || '-1' ELSE base END AS next_name
FROM (SELECT 'Release ' || strftime(o_orderdate, '%Y%m%d') AS base, max(CASE WHEN o_custkey % 4 = 0 THEN 1 ELSE 0 END) AS h0,
             max(CASE WHEN o_custkey % 4 = 1 THEN 1 ELSE 0 END) AS h1, max(CASE WHEN o_custkey % 4 = 2 THEN 1 ELSE 0 END) AS h2
      FROM orders GROUP BY 1) x"""))(p36_release_names)


def s11_copy_release(spark, sf_dir):
    """S11 copy of the latest release's facts under a new id, L60 repair of release ids by (month, program)."""
    m = Model(spark, sf_dir)
    d = m.demand.select("order_id", "line_id", "dim_release_id", "buying_program", "quantity")
    new = releases.copy_previous(d, "dim_release_id", 999912)
    both = d.withColumn("is_from_previous_release", F.lit(0)).unionByName(new)
    fix = m.demand.filter(F.col("buying_program") == "Bulk Buy").select("buying_program", F.col("dim_release_id").alias("_r"), F.col("dim_release_id")).distinct()
    fix = fix.select("buying_program", (F.col("dim_release_id") + 1000000).alias("repaired"), F.col("_r").alias("dim_release_id"))
    out = releases.repair_release_id(both.withColumn("repaired", F.col("dim_release_id")), fix, ["buying_program", "dim_release_id"], "repaired")
    return out.groupBy("repaired", "is_from_previous_release").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


query("s11_copy_release", sql("""
SELECT CASE WHEN c = 0 AND buying_program = 'Bulk Buy' THEN dim_release_id + 1000000 WHEN c = 1 THEN 999912 ELSE dim_release_id END AS repaired,
       c AS is_from_previous_release, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity
FROM (SELECT *, 0 AS c FROM demand UNION ALL SELECT *, 1 FROM demand WHERE dim_release_id = (SELECT max(dim_release_id) FROM demand)) x
GROUP BY 1, 2""", "demand"))(s11_copy_release)


def l01_priority_list(spark, sf_dir):
    """L01 priority-list load: staged material and factory names to ids, MAX per product."""
    m = Model(spark, sf_dir)
    names = m.factory.select("dim_factory_id", "short_name")
    n = lambda i: names.select(F.col("dim_factory_id").alias(f"f{i}"), F.col("short_name").alias(f"factory_{i}"))
    li = m.lines.select("dim_product_id", F.col("dim_factory_id_original").alias("f1"), ((F.col("dim_factory_id_original") * 7) % 120).alias("f2"))
    staged = li.join(n(1), "f1").join(n(2), "f2", "left").join(m.product.select("dim_product_id", "material_id"), "dim_product_id")
    staged = staged.select(F.when(F.col("dim_product_id") % 9 != 0, F.col("material_id")).otherwise("VN?").alias("material_id"), "factory_1", "factory_2")
    return releases.load_priority(staged, m.product, m.factory, F.lit(202001))


query("l01_priority_list", sql("""
SELECT l_partkey AS dim_product_id, max(a.fid) AS dim_factory_id_1, max(b.fid) AS dim_factory_id_2, 202001 AS dim_release_id
FROM lineitem JOIN nm a ON a.id = l_suppkey LEFT JOIN nm b ON b.id = (l_suppkey * 7) % 120 WHERE l_partkey % 9 <> 0 AND l_partkey IN (SELECT p_partkey FROM part) GROUP BY 1""", "factory",
    local=(("nm", "SELECT f.dim_factory_id AS id, g.fid FROM factory f JOIN (SELECT short_name, max(dim_factory_id) AS fid FROM factory GROUP BY 1) g USING (short_name)"),)))(l01_priority_list)
