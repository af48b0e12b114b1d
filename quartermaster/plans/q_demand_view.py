"""The wide demand view of the current release (R01-R03): thirteen roles, four optional lookups, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, logic
from ..operators.demand_view import Role, demand_view, moq_label
from ..operators.lookups import scalar
from .model import BUYING_PROGRAMS, DEMAND_CATEGORIES, Model
from .model_sql import sql
from .registry import query

FACTORY = ["vendor_group", "short_name", "factory_region", "country_code"]
DATE = ["full_date", "season_buy", "season_year_buy", "season_year_short_buy", "season_crd", "season_year_crd", "season_year_short_crd", "season_intro",
        "season_year_intro", "season_year_short_intro", "year_accounting", "month_name_accounting", "month_name_short_accounting"]
PRODUCT = ["material_id", "style_id", "style_name", "cat_sub_sbu", "style_complexity", "construction_type", "production_lt"]
ROLES = [
    Role("release", "release", {"id": "dim_release_id"}, ["full_date", "comment"]),
    Role("buy_month", "date", {"id": "dim_date_id_buy_month"}, ["year_month_accounting"]),
    Role("business", "business", {"id": "dim_business_id"}, ["brand"]),
    Role("program", "program", {"name": "buying_program"}, ["name", "name_short"]),
    Role("product", "product", {"dim_product_id": "dim_product_id"}, PRODUCT),
    Role("demand_date", "date", {"id": "dim_date_id"}, DATE),
    Role("original_date", "date", {"id": "dim_date_id_original"}, ["full_date"]),
    Role("factory_unconstrained", "factory", {"dim_factory_id": "dim_factory_id_original_unconstrained"}, FACTORY),
    Role("factory_constrained", "factory", {"dim_factory_id": "dim_factory_id_original_constrained"}, FACTORY),
    Role("factory_final", "factory", {"dim_factory_id": "dim_factory_id_final"}, FACTORY),
    Role("factory", "factory", {"dim_factory_id": "dim_factory_id"}, FACTORY),
    Role("customer", "customer", {"dim_customer_id": "dim_customer_id"}, ["customer_name", "market", "sold_to_category", "sold_to_party", "region"]),
    Role("category", "category", {"name": "demand_category"}, ["name"]),
    Role("priority", "priority", {"material_id": "product.material_id"}, ["factory_short_name_1", "factory_short_name_2"], optional=True),
    Role("quick_turn", "fty_qt", {"material_id": "product.material_id"}, ["factory_short_name"], optional=True),
    Role("retail_quick_turn", "retail_qt", {"material_id": "product.material_id", "region": "customer.region", "sold_to_party": "customer.sold_to_party"},
         ["factory_short_name"], optional=True),
    Role("confirmed_date", "date", {"full_date": "confirmed_crd_dt"}, ["year_cw_accounting"], optional=True),
]


def _dimensions(m: Model) -> dict:
    spark = m.spark
    cal = F.broadcast(m.calendar)  # one row a day, bounded by the dates of the data
    names = m.factory.groupBy("dim_factory_id").agg(F.max("short_name").alias("short_name"))
    first, second = names.toDF("dim_factory_id_1", "factory_short_name_1"), names.toDF("dim_factory_id_2", "factory_short_name_2")
    material = m.product.select("dim_product_id", "material_id")
    return {
        "date": cal, "product": m.product, "factory": m.factory, "customer": m.customer,
        "release": cal.filter(F.dayofmonth("full_date") == 1).select((F.col("id") / 100).cast("int").alias("id"), "full_date",
                                                                    F.concat(F.lit("Release "), "year_month_accounting").alias("comment")),
        "business": m.table("region").select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("brand")),
        "program": spark.createDataFrame([(n, "".join(w[0] for w in n.split())) for n in BUYING_PROGRAMS.values()], "name string, name_short string"),
        "category": spark.createDataFrame([(n,) for n in DEMAND_CATEGORIES.values()], "name string"),
        "priority": m.priority.join(material, "dim_product_id").join(first, "dim_factory_id_1").join(second, "dim_factory_id_2", "left").select(
            "material_id", "factory_short_name_1", "factory_short_name_2"),
        "fty_qt": m.fty_qt.groupBy("material_id").agg(F.max("factory_short_name").alias("factory_short_name")),
        "retail_qt": m.retail_qt.groupBy("material_id", "region", "sold_to_party").agg(F.max("factory_short_name").alias("factory_short_name")),
    }


def _facts(m: Model):
    """The current release's demand with the keys, dates, quantities and flags of the view."""
    current = scalar(m.table("orders").agg(F.max(F.year("o_orderdate")).alias("year")))["year"]  # a release a year, named by its first month
    k, f, n = F.col("order_id"), F.col("dim_factory_id_original"), F.col("line_id")
    d = m.demand.filter(F.year("release_date") == F.lit(current))
    return d.select(
        (F.year("release_date") * 100 + 1).alias("dim_release_id"), (k % 5).alias("dim_business_id"), "buying_program", "dim_product_id", "dim_date_id",
        dates.date_id(F.date_add("release_date", 40)).alias("dim_date_id_original"), dates.date_id("release_date").alias("dim_date_id_buy_month"),
        f.alias("dim_factory_id_original_unconstrained"), F.when(k % 4 == 0, f * 3 % 110).otherwise(f).alias("dim_factory_id_original_constrained"),
        F.when(k % 6 == 0, f * 7 % 90).otherwise(f).alias("dim_factory_id_final"), f.alias("dim_factory_id"), "dim_customer_id", "demand_category",
        F.concat_ws("-", F.lit("ORDER"), k, n).alias("order_number"), "quantity", (k % 300).alias("customer_moq"),
        F.when(k % 8 != 0, k * n % 600).alias("region_moq"), F.when(k % 3 == 0, F.date_add("demand_date", 5)).alias("confirmed_crd_dt"),
        (n == 1).cast("int").alias("is_asap"), (k % 2).cast("int").alias("customer_below_moq"), F.when(n % 3 != 0, (n % 2)).cast("int").alias("region_below_moq"),
        F.col("is_edited").alias("is_rejected"))


def r01_wide_view(spark, sf_dir):
    """R01 the whole view, R02 reallocated flag, R03 MOQ labels, Y/N flags, currency and the regional vendor codes."""
    m = Model(spark, sf_dir)
    region, final = F.col("customer.region"), "factory_final"
    apac = region == "APAC"
    derived = {
        "is_reallocated": F.when(F.col("dim_factory_id_original_unconstrained") == F.col("dim_factory_id_original_constrained"), "N").otherwise("Y"),
        "order_number_short": F.left("order_number", F.lit(10)), "asap": F.when(F.col("is_asap") == 1, "ASAP").otherwise(""),
        "customer_moq_label": moq_label("customer_moq", [96, 240]), "region_moq_label": moq_label("region_moq", [96, 240, 480]),
        **{f"{c}_yn": logic.yes_no(c) for c in ("customer_below_moq", "region_below_moq", "is_rejected")},
        **{f"product_{c}_mtl_yn": logic.yes_no(F.col(f"product.{c}_mtl")) for c in ("clk", "dtp", "sjd", "qt")},
        "material_id_sr": F.when(region == "EMEA", F.concat(F.lit("E"), "product.material_id")).otherwise(F.col("product.style_id")),
        "product_sku": F.when(apac, F.concat_ws("/", "product.material_id", "product.style_id")),
        "currency": F.when((F.col("customer.customer_name") == "Customer#000000007") & (F.col(f"{final}.country_code") == "CN"), "RMB").otherwise("USD"),
        "vendor_plnt_conf": F.when(apac, F.concat(F.lit("R"), f"{final}.vendor_group")).otherwise(F.concat(F.lit("A"), f"{final}.vendor_group")),
        "vendor_number_conf": F.when(apac, F.col(f"{final}.short_name")).otherwise(F.upper(f"{final}.short_name")),
        "demand_date_cw": F.right("demand_date.year_cw_accounting", F.lit(4)),
    }
    # the labels read a few more columns of their dimensions
    extra = {"product": ["clk_mtl", "dtp_mtl", "sjd_mtl", "qt_mtl"], "demand_date": ["year_cw_accounting"]}
    roles = [Role(r.name, r.dimension, r.on, [*r.columns, *extra.get(r.name, [])], r.optional) for r in ROLES]
    view = demand_view(_facts(m), _dimensions(m), roles, derived)
    return view.drop("demand_date_year_cw_accounting", *[f"product_{c}" for c in extra["product"]], "is_asap")


def _cols(alias: str, name: str, columns) -> str:
    return ", ".join(f"{alias}.{c} AS {name}_{c}" for c in columns)


_FLAG = "CASE WHEN {0} = 1 THEN 'Y' ELSE 'N' END"
query("r01_wide_view", sql(f"""
SELECT f.release AS dim_release_id, dim_business_id, f.buying_program, f.dim_product_id, f.dim_date_id, dim_date_id_original, dim_date_id_buy_month,
       f.fu AS dim_factory_id_original_unconstrained, f.fc AS dim_factory_id_original_constrained, f.ff AS dim_factory_id_final, f.fu AS dim_factory_id, f.dim_customer_id,
       f.demand_category, order_number, quantity, customer_moq, region_moq, confirmed_crd_dt, customer_below_moq, region_below_moq, is_edited AS is_rejected,
       rel.full_date AS release_full_date, 'Release ' || rel.year_month_accounting AS release_comment, bm.year_month_accounting AS buy_month_year_month_accounting,
       r_name AS business_brand, f.buying_program AS program_name, CASE f.buying_program WHEN 'Retail Quick Turn' THEN 'RQT' WHEN 'Ad-Hoc Out of Sync' THEN 'AOoS'
         WHEN 'Bulk Buy' THEN 'BB' WHEN 'Scheduled Out of Sync' THEN 'SOoS' ELSE 'AHVQT' END AS program_name_short,
       {_cols('p', 'product', PRODUCT)}, {_cols('dd', 'demand_date', DATE)}, od.full_date AS original_date_full_date,
       {_cols('u', 'factory_unconstrained', FACTORY)}, {_cols('k', 'factory_constrained', FACTORY)}, {_cols('n', 'factory_final', FACTORY)}, {_cols('u', 'factory', FACTORY)},
       {_cols('c', 'customer', ["customer_name", "market", "sold_to_category", "sold_to_party", "region"])}, f.demand_category AS category_name,
       p1.short_name AS priority_factory_short_name_1, p2.short_name AS priority_factory_short_name_2, q.v AS quick_turn_factory_short_name,
       rq.v AS retail_quick_turn_factory_short_name, cd.year_cw_accounting AS confirmed_date_year_cw_accounting,
       CASE WHEN f.fu = f.fc THEN 'N' ELSE 'Y' END AS is_reallocated, substr(order_number, 1, 10) AS order_number_short, CASE WHEN line_id = 1 THEN 'ASAP' ELSE '' END AS asap,
       CASE WHEN customer_moq >= 240 THEN '>= 240' WHEN customer_moq >= 96 THEN '96 - 239' ELSE '< 96' END AS customer_moq_label,
       CASE WHEN region_moq >= 480 THEN '>= 480' WHEN region_moq >= 240 THEN '240 - 479' WHEN region_moq >= 96 THEN '96 - 239' ELSE '< 96' END AS region_moq_label,
       {_FLAG.format('customer_below_moq')} AS customer_below_moq_yn, {_FLAG.format('region_below_moq')} AS region_below_moq_yn, {_FLAG.format('is_edited')} AS is_rejected_yn,
       {", ".join(_FLAG.format(f'p.{x}_mtl') + f' AS product_{x}_mtl_yn' for x in ('clk', 'dtp', 'sjd', 'qt'))},
       CASE WHEN c.region = 'EMEA' THEN 'E' || p.material_id ELSE p.style_id END AS material_id_sr, CASE WHEN c.region = 'APAC' THEN p.material_id || '/' || p.style_id END AS product_sku,
       CASE WHEN c.customer_name = 'Customer#000000007' AND n.country_code = 'CN' THEN 'RMB' ELSE 'USD' END AS currency,
       CASE WHEN c.region = 'APAC' THEN 'R' ELSE 'A' END || n.vendor_group AS vendor_plnt_conf,
       CASE WHEN c.region = 'APAC' THEN n.short_name ELSE upper(n.short_name) END AS vendor_number_conf, right(dd.year_cw_accounting, 4) AS demand_date_cw
FROM (SELECT *, CAST(year(release_date) * 100 + 1 AS INTEGER) AS release, order_id % 5 AS dim_business_id, dim_factory_id_original AS fu,
             CASE WHEN order_id % 4 = 0 THEN dim_factory_id_original * 3 % 110 ELSE dim_factory_id_original END AS fc,
             CASE WHEN order_id % 6 = 0 THEN dim_factory_id_original * 7 % 90 ELSE dim_factory_id_original END AS ff,
             release_date + 40 AS original_day, CAST(year(release_date + 40) * 10000 + month(release_date + 40) * 100 + day(release_date + 40) AS INTEGER) AS dim_date_id_original,
             CAST(year(release_date) * 10000 + month(release_date) * 100 + 1 AS INTEGER) AS dim_date_id_buy_month,
             'ORDER-' || order_id || '-' || line_id AS order_number, order_id % 300 AS customer_moq, CASE WHEN order_id % 8 <> 0 THEN order_id * line_id % 600 END AS region_moq,
             CASE WHEN order_id % 3 = 0 THEN demand_date + 5 END AS confirmed_crd_dt, CAST(order_id % 2 AS INTEGER) AS customer_below_moq,
             CASE WHEN line_id % 3 <> 0 THEN CAST(line_id % 2 AS INTEGER) END AS region_below_moq
      FROM demand WHERE year(release_date) = (SELECT max(year(o_orderdate)) FROM orders)) f
JOIN calendar rel ON rel.id = release * 100 + 1 JOIN calendar bm ON bm.id = f.dim_date_id_buy_month JOIN region ON r_regionkey = dim_business_id
JOIN product p USING (dim_product_id) JOIN calendar dd ON dd.id = f.dim_date_id JOIN calendar od ON od.full_date = original_day
JOIN factory u ON u.dim_factory_id = fu JOIN factory k ON k.dim_factory_id = fc JOIN factory n ON n.dim_factory_id = ff JOIN customer c USING (dim_customer_id)
LEFT JOIN priority pr USING (dim_product_id) LEFT JOIN factory p1 ON p1.dim_factory_id = pr.dim_factory_id_1 LEFT JOIN factory p2 ON p2.dim_factory_id = pr.dim_factory_id_2
LEFT JOIN (SELECT material_id, max(factory_short_name) AS v FROM fty_qt GROUP BY 1) q ON q.material_id = p.material_id
LEFT JOIN (SELECT material_id, region, sold_to_party, max(factory_short_name) AS v FROM retail_qt GROUP BY 1, 2, 3) rq
       ON rq.material_id = p.material_id AND rq.region = c.region AND rq.sold_to_party = c.sold_to_party
LEFT JOIN calendar cd ON cd.full_date = confirmed_crd_dt""", "demand", "priority", "product", "customer", "factory", "calendar", "fty_qt", "retail_qt"))(r01_wide_view)
