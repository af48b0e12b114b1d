"""Queries for loads and adjustments of demand and capacity (L*).  Twins are written out by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import date_id
from ..operators import adjust, capacity
from .model import Model
from .model_sql import date_id as sql_date_id
from .model_sql import sql
from .registry import query

WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
#: Test binding of the minimum-quantity policy: (product type, region threshold, customer threshold, upcharge).
POLICY = [("Regular", 60, 20, 0.5), ("Regular", 30, 35, 0.75), ("Vault", 60, 25, 1.25), ("Vault", 45, 40, 1.0), ("ArcAd", 45, 15, 2.0)]
#: Test binding of the delivery classes by days of delay.
PERFORMANCE = [(-5, "Early"), (0, "On time"), (4, "Late"), (9, "Very late")]


# ------------------------------------------------------------------------------------------------ netting, labels
def l40_netting(spark, sf_dir):
    """L40 netting of need-to-buy lines (odd line numbers) against the summed orders (even ones) of the same product group,
    delivery month, customer and order: the four keys of the load, coarse enough here that lines meet."""
    d = Model(spark, sf_dir).demand.select(
        "order_id", "line_id", "dim_customer_id", (F.col("dim_product_id") % 4).alias("product_group"), F.date_format("demand_date", "yyyy-MM").alias("month"),
        F.col("quantity").alias("quantity_unconsumed"), "quantity", F.lit(None).cast("bigint").alias("consumed_quantity"))
    key = ["product_group", "month", "dim_customer_id", "order_id"]
    return adjust.net_demand(d.filter("line_id % 2 = 1"), d.filter("line_id % 2 = 0"), key)


query("l40_netting", sql("""
SELECT n.order_id, n.line_id, n.dim_customer_id, n.product_group, n.month, n.quantity AS quantity_unconsumed,
       CASE WHEN o.q IS NULL THEN n.quantity WHEN n.quantity < o.q THEN 0 ELSE n.quantity - o.q END AS quantity,
       abs(o.q - n.quantity) AS consumed_quantity
FROM (SELECT *, dim_product_id % 4 AS product_group, strftime(demand_date, '%Y-%m') AS month FROM demand WHERE line_id % 2 = 1) n
LEFT JOIN (SELECT order_id, dim_customer_id, dim_product_id % 4 AS product_group, strftime(demand_date, '%Y-%m') AS month, CAST(sum(quantity) AS BIGINT) AS q
           FROM demand WHERE line_id % 2 = 0 GROUP BY 1, 2, 3, 4) o USING (order_id, dim_customer_id, product_group, month)""", "demand"))(l40_netting)


def l05_source_label(spark, sf_dir):
    """L05 single or dual source of every forecast line, L14 lead time, summed by label and release."""
    m = Model(spark, sf_dir)
    names = m.factory.select(F.col("dim_factory_id").alias("dim_factory_id_1"), "short_name")
    j = (m.demand.filter(F.col("demand_category") == "Forecast").join(m.product.select("dim_product_id", "style_complexity"), "dim_product_id")
          .join(m.priority.join(names, "dim_factory_id_1"), "dim_product_id"))
    label = adjust.source_label(F.col("dim_factory_id_2"), F.col("style_complexity"), F.col("short_name"))
    return j.groupBy(label.alias("source"), "dim_release_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(adjust.lead_time(F.col("demand_date"), F.col("release_date"))).alias("lead_days"))


query("l05_source_label", sql("""
SELECT CASE WHEN coalesce(p.dim_factory_id_2, 0) <> 0 OR lower(style_complexity) LIKE '%flex%'
                 OR f.short_name NOT IN ('CLK', 'DTP', 'SJD', 'MTL') THEN 'Dual source' ELSE 'Single source' END AS source,
       dim_release_id, count(*) AS n_lines, CAST(sum(date_diff('day', release_date, demand_date)) AS BIGINT) AS lead_days
FROM demand d JOIN product USING (dim_product_id) JOIN priority p USING (dim_product_id)
JOIN factory f ON f.dim_factory_id = p.dim_factory_id_1 WHERE demand_category = 'Forecast' GROUP BY 1, 2""",
    "demand", "product", "priority", "factory"))(l05_source_label)


# ------------------------------------------------------------------------------------------------ cutoff days
def l41_cutoff(spark, sf_dir):
    """L41 cutoff weekday of the factory's port (here its country's) for European sold-to types."""
    m = Model(spark, sf_dir)
    s = m.table("supplier")
    days = F.array(*[F.lit(d) for d in WEEKDAYS])
    nk = F.col("s_nationkey")
    cut = s.select(F.col("s_suppkey").alias("dim_factory_id"),
                   F.when(nk % 5 != 0, F.element_at(days, nk % 7 + 1)).alias("cutoff_day_dc"),
                   F.when(nk % 4 != 0, F.element_at(days, (nk + 2) % 7 + 1)).alias("cutoff_day_crossdock"))
    d = (m.demand.join(m.customer.filter(F.col("sold_to_party").isin("EU DC", "EU Crossdock", "UK DC")).select("dim_customer_id", "sold_to_party"),
                       "dim_customer_id")
          .select("order_id", "line_id", "sold_to_party", F.col("dim_factory_id_original").alias("dim_factory_id"), "dim_date_id"))
    return adjust.cutoff_adjust(d, cut, m.calendar)


_day = lambda e: f"([{', '.join(repr(d) for d in WEEKDAYS)}])[CAST({e} AS INTEGER) + 1]"
query("l41_cutoff", sql(f"""
SELECT d.order_id, d.line_id, c.sold_to_party, d.dim_factory_id_original AS dim_factory_id, coalesce(t.id, d.dim_date_id) AS dim_date_id
FROM demand d JOIN customer c ON c.dim_customer_id = d.dim_customer_id AND c.sold_to_party IN ('EU DC', 'EU Crossdock', 'UK DC')
JOIN supplier s ON s.s_suppkey = d.dim_factory_id_original
LEFT JOIN calendar k ON k.id = d.dim_date_id
LEFT JOIN calendar t ON t.year_cw_accounting = k.year_cw_accounting AND t.day_name_of_week =
     CASE c.sold_to_party WHEN 'EU DC' THEN CASE WHEN s_nationkey % 5 <> 0 THEN {_day('s_nationkey % 7')} END
                          WHEN 'EU Crossdock' THEN CASE WHEN s_nationkey % 4 <> 0 THEN {_day('(s_nationkey + 2) % 7')} END END""",
    "demand", "customer", "calendar"))(l41_cutoff)


# ------------------------------------------------------------------------------------------------ minimum quantities
def l42_moq(spark, sf_dir):
    """L42-L45 minimum order quantities: material totals by region and customer, thresholds, flags, upcharge."""
    from ..functions.text import product_type
    m = Model(spark, sf_dir)
    f = (m.demand.filter(F.col("demand_category") == "Need to Buy")
          .join(m.customer.select("dim_customer_id", "region"), "dim_customer_id")
          .join(m.product.select("dim_product_id", "material_id", product_type("cat_sub_sbu").alias("product_type")), "dim_product_id")
          .join(m.factory.select(F.col("dim_factory_id").alias("dim_factory_id_original"), "vendor_group"), "dim_factory_id_original"))
    f = f.select("order_id", "line_id", F.col("buying_program").alias("program"), F.col("demand_category").alias("category"), "dim_date_id",
                 F.col("dim_factory_id_original").alias("dim_factory_id"), "vendor_group", "region", "dim_customer_id", "material_id", "product_type", "quantity")
    policy = spark.createDataFrame(POLICY, "product_type string, from_by_region int, from_by_customer int, upcharge double")
    return adjust.moq(f, policy).select("order_id", "line_id", "quantity_region", "quantity_customer", "region_moq", "region_below_moq",
                                        "customer_moq", "customer_below_moq", "upcharge")


query("l42_moq", sql(f"""
SELECT order_id, line_id, quantity_region, quantity_customer, region_moq, region_below_moq, customer_moq, customer_below_moq,
       CASE WHEN customer_moq IS NULL THEN NULL WHEN customer_below_moq = 1 THEN
         (SELECT max(h2.upcharge) FROM policy h JOIN policy h2 ON h.from_by_region = h2.from_by_region
          WHERE h.product_type = c.product_type AND h.from_by_customer = c.customer_moq) ELSE 0.0 END::DOUBLE AS upcharge
FROM (SELECT b.*, CASE WHEN quantity_customer < customer_moq THEN 1 ELSE 0 END AS customer_below_moq
      FROM (SELECT a.*, CASE WHEN region_below_moq = 1
                        THEN (SELECT max(from_by_customer) FROM policy h WHERE h.from_by_region <> a.region_moq AND h.product_type = a.product_type)
                        ELSE (SELECT max(from_by_customer) FROM policy h WHERE h.from_by_region = a.region_moq AND h.product_type = a.product_type) END AS customer_moq
            FROM (SELECT t.*, CASE WHEN region_moq IS NULL THEN NULL WHEN quantity_region < region_moq THEN 1 ELSE 0 END AS region_below_moq
                  FROM (SELECT f.*, (SELECT max(from_by_region) FROM policy h WHERE h.product_type = f.product_type) AS region_moq,
                               CAST(sum(quantity) OVER (PARTITION BY buying_program, demand_category, dim_factory_id_original, region, material_id) AS BIGINT) AS quantity_region,
                               CAST(sum(quantity) OVER (PARTITION BY buying_program, demand_category, dim_date_id, vendor_group, dim_customer_id, material_id) AS BIGINT) AS quantity_customer
                        FROM ntb f) t) a) b) c""", "demand", "customer", "product", "factory", local=(
    ("policy", "SELECT * FROM (VALUES " + ", ".join(repr(r) for r in POLICY) + ") v(product_type, from_by_region, from_by_customer, upcharge)"),
    ("ntb", """SELECT d.*, region, vendor_group, material_id, CASE WHEN lower(cat_sub_sbu) LIKE '%vault%' THEN 'Vault'
                      WHEN lower(cat_sub_sbu) LIKE '%arcad%' THEN 'ArcAd' ELSE 'Regular' END AS product_type
               FROM demand d JOIN customer USING (dim_customer_id) JOIN product USING (dim_product_id)
               JOIN factory f ON f.dim_factory_id = d.dim_factory_id_original WHERE demand_category = 'Need to Buy'"""))))(l42_moq)


# ------------------------------------------------------------------------------------------------ overrides
def _override_base(m):
    return m.demand.select("order_id", "line_id", F.col("dim_factory_id_original").alias("dim_factory_id"), "dim_date_id",
                           F.col("release_date").alias("buy_date"), F.concat(F.lit("PO"), F.col("order_id").cast("string")).alias("order_number"))


def l50_override_region(spark, sf_dir):
    """L50 override from the region report: order numbers (NULL to 'UNDEFINED'), remark, below-minimum flag."""
    m = Model(spark, sf_dir)
    base = _override_base(m).dropDuplicates(["order_id", "line_id"]).select("order_id", "line_id", "order_number",
                                                                            F.lit(None).cast("string").alias("remarks"), F.lit(None).cast("int").alias("region_below_moq"))
    li = m.table("lineitem")
    rep = li.filter("l_orderkey % 3 = 0").groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_id")).agg(
        F.max(F.when(F.col("l_orderkey") % 2 == 0, F.concat(F.lit("R"), F.col("l_orderkey").cast("string")))).alias("order_number"),
        F.max("l_returnflag").alias("remarks"), F.max(F.when(F.col("l_linestatus") == "O", "Y").otherwise("N")).alias("region_below_moq"))
    return adjust.override_region(base, rep, ["order_id", "line_id"])


query("l50_override_region", sql("""
SELECT k.order_id, k.line_id, CASE WHEN k.order_id % 3 <> 0 THEN 'PO' || CAST(k.order_id AS VARCHAR)
         WHEN k.order_id % 2 = 0 THEN 'R' || CAST(k.order_id AS VARCHAR) ELSE 'UNDEFINED' END AS order_number,
       CASE WHEN k.order_id % 3 = 0 THEN remarks END AS remarks, CASE WHEN k.order_id % 3 = 0 THEN open END AS region_below_moq
FROM (SELECT l_orderkey AS order_id, l_linenumber AS line_id, max(l_returnflag) AS remarks,
             CAST(max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS INTEGER) AS open
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) k"""))(l50_override_region)


def l51_override_vendor(spark, sf_dir):
    """L51 override from the vendor report: lead time, delay and its class, requested date, final factory or placeholder."""
    m = Model(spark, sf_dir)
    base = _override_base(m).groupBy("order_id").agg(F.min("buy_date").alias("buy_date"), F.min("dim_date_id").alias("dim_date_id"))
    li = m.table("lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").cast("date").alias("d"), F.min("l_suppkey").alias("s"))
    k = F.col("l_orderkey")
    rep = li.filter(k % 4 != 0).select(
        k.alias("order_id"), F.col("d").alias("requested_crd"), F.date_add("d", (k % 15).cast("int") - 5).alias("confirmed_crd"),
        F.col("s").alias("s_suppkey"), F.concat(F.lit("c"), (k % 3).cast("string")).alias("comment_vendor"))
    names = m.factory.select(F.col("dim_factory_id").alias("s_suppkey"), "short_name")
    rep = rep.join(names, "s_suppkey").withColumn("final_factory", F.when(F.col("order_id") % 5 == 0, "???").otherwise(F.col("short_name")))
    perf = spark.createDataFrame(PERFORMANCE, "days_delay int, delivery_performance string")
    out = adjust.override_vendor(base, rep.drop("s_suppkey", "short_name"), ["order_id"], m.factory, m.calendar, perf, -1)
    return out.select("order_id", "dim_date_id", date_id("confirmed_crd").alias("confirmed_id"), "status_orig_req", "delivery_performance",
                      "dim_factory_id_final", "comment_vendor", "production_lt_actual_vendor")


query("l51_override_vendor", sql(f"""
SELECT b.order_id, CASE WHEN hit THEN {sql_date_id('d')} ELSE b.dim_date_id END AS dim_date_id,
       CASE WHEN hit THEN {sql_date_id('(d + (late - 5))')} END AS confirmed_id, CASE WHEN hit THEN late - 5 END AS status_orig_req,
       CASE WHEN hit THEN CASE late - 5 WHEN -5 THEN 'Early' WHEN 0 THEN 'On time' WHEN 4 THEN 'Late' WHEN 9 THEN 'Very late' END END AS delivery_performance,
       CASE WHEN hit THEN CASE WHEN b.order_id % 5 = 0 THEN -1 ELSE fid END END AS dim_factory_id_final,
       CASE WHEN hit THEN 'c' || CAST(b.order_id % 3 AS VARCHAR) END AS comment_vendor,
       CASE WHEN hit THEN CAST(date_diff('day', buy_date, d + (late - 5)) AS INTEGER) END AS production_lt_actual_vendor
FROM (SELECT order_id, min(release_date) AS buy_date, min(dim_date_id) AS dim_date_id FROM demand GROUP BY 1) b
JOIN (SELECT l_orderkey, l_orderkey % 4 <> 0 AS hit, CAST(min(l_shipdate) AS DATE) AS d, CAST(l_orderkey % 15 AS INTEGER) AS late, min(l_suppkey) AS s
      FROM lineitem GROUP BY 1) r ON r.l_orderkey = b.order_id
JOIN (SELECT f.dim_factory_id AS s, g.fid FROM factory f JOIN (SELECT short_name, max(dim_factory_id) AS fid FROM factory GROUP BY 1) g USING (short_name)) n USING (s)
""", "demand", "factory"))(l51_override_vendor)


def l52_override_allocation(spark, sf_dir):
    """L52 override by the allocation team: factory by short name (unknown codes change nothing), comment, edit time."""
    m = Model(spark, sf_dir)
    base = m.table("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.min("l_suppkey").alias("dim_factory_id"))
    k = F.col("order_id")
    codes = m.factory.select(F.col("dim_factory_id").alias("_to"), "short_name")
    rep = (base.filter(k % 2 == 0).withColumn("_to", F.col("dim_factory_id") + 1).join(codes, "_to", "left")
               .select("order_id", F.when(k % 6 == 0, "nowhere").otherwise(F.col("short_name")).alias("factory_code"),
                       F.concat(F.lit("moved "), k.cast("string")).alias("comment_vfa"), F.lit("HK").alias("component_factory_short_name")))
    out = adjust.override_allocation(base, rep, ["order_id"], m.factory, F.lit(20200101))
    return out.select("order_id", "dim_factory_id", "comment_vfa", "component_factory_short_name", "edit_dt")


query("l52_override_allocation", sql("""
SELECT b.order_id, coalesce(t.fid, b.f) AS dim_factory_id, CASE WHEN t.fid IS NOT NULL THEN 'moved ' || CAST(b.order_id AS VARCHAR) END AS comment_vfa,
       CASE WHEN t.fid IS NOT NULL THEN 'HK' END AS component_factory_short_name, CASE WHEN t.fid IS NOT NULL THEN 20200101 END AS edit_dt
FROM (SELECT l_orderkey AS order_id, min(l_suppkey) AS f FROM lineitem GROUP BY 1) b
LEFT JOIN (SELECT a.dim_factory_id, max(c.dim_factory_id) AS fid FROM factory a JOIN factory c USING (short_name) GROUP BY 1) t
  ON t.dim_factory_id = b.f + 1 AND b.order_id % 2 = 0 AND b.order_id % 6 <> 0""", "factory"))(l52_override_allocation)


# ------------------------------------------------------------------------------------------------ capacity
def _capacity_inputs(m):
    fid = F.col("dim_factory_id")
    helper = m.factory.filter(fid % 3 != 0).select(
        F.col("short_name").alias("factory_short_name"), F.when(fid % 2 == 0, 0.4).alias("APAC"), F.lit(0.3).alias("EMEA"),
        F.lit(0.2).alias("CASA"), F.lit(0.1).alias("NORA"))
    adjustment = m.factory.filter(fid % 4 == 0).select(F.col("short_name").alias("factory_short_name"), F.lit(0.9).alias("percentage"),
                                                       F.lit(0.8).alias("percentage_adjustment"))
    kinds = m.product.select(F.col("construction_type").alias("name")).distinct()
    mapping = kinds.select(F.lit("Construction Type Master").alias("category"), F.col("name").alias("parent"), F.lower("name").alias("child")).unionByName(
        m.factory.filter(fid % 5 == 0).select(F.lit("Factory Master").alias("category"), F.col("short_name").alias("parent"),
                                              F.concat(F.lit("old "), F.col("short_name")).alias("child")))
    # the lines are summed before their factories' names are looked up
    by = ["dim_factory_id_original", "construction_type", "demand_date"]
    d = m.lines.join(m.product.select("dim_product_id", "construction_type"), "dim_product_id").select(*by, "quantity").repartition(m.parts, *by)
    raw = (d.groupBy("dim_factory_id_original", "construction_type", F.col("demand_date").alias("day")).agg(F.sum("quantity").alias("quantity"))
            .join(m.factory.select(fid.alias("dim_factory_id_original"), "short_name"), "dim_factory_id_original"))
    f = F.col("dim_factory_id_original")
    raw = raw.select(F.when(f % 10 == 0, F.concat(F.lit("old "), "short_name")).when(f % 10 == 1, "nobody").otherwise(F.col("short_name")).alias("factory_name"),
                     F.when(f % 2 == 0, F.lower("construction_type")).otherwise(F.col("construction_type")).alias("construction_name"), "day",
                     "quantity", F.when(F.dayofmonth("day") % 2 == 0, F.col("quantity") - 20).alias("quantity_adjusted"))
    return helper, adjustment, kinds, mapping, raw


def l31_daily_capacity(spark, sf_dir):
    """L30 regional shares, L31 daily capacity by share and adjustment, L32 weekly roll-up onto the week's first day."""
    m = Model(spark, sf_dir)
    helper, adjustment, kinds, mapping, raw = _capacity_inputs(m)
    shares = capacity.region_shares(helper, m.factory)
    daily = capacity.daily_capacity(raw, m.factory, kinds, mapping, shares, adjustment, m.calendar, "ALL", m.parts * len(capacity.REGIONS))
    out = capacity.weekly_rollup(daily, m.calendar)
    return out.withColumns({c: F.round(c, 4) for c in ("capacity_raw_daily", "capacity_raw_daily_overwritten", "capacity_raw_weekly", "capacity_raw_weekly_overwritten")})


_NAMED = ("SELECT short_name, max(dim_factory_id) AS fid FROM factory GROUP BY 1")
_CAP_LOCAL = (
    ("named", _NAMED),
    ("shares", """SELECT n.fid, s.region, max(s.share) AS share FROM factory f JOIN named n USING (short_name)
                  CROSS JOIN LATERAL (VALUES ('APAC', CASE WHEN f.dim_factory_id % 2 = 0 THEN 0.4e0 END), ('EMEA', 0.3e0), ('CASA', 0.2e0), ('NORA', 0.1e0)) s(region, share)
                  WHERE f.dim_factory_id % 3 <> 0 AND s.share IS NOT NULL GROUP BY 1, 2"""),
    ("adj", "SELECT DISTINCT n.fid FROM factory f JOIN named n USING (short_name) WHERE f.dim_factory_id % 4 = 0"),
    ("daily", """SELECT r.fid AS dim_factory_id, coalesce(s.region, 'ALL') AS region, r.construction_type, r.dim_date_id,
                        r.q * coalesce(s.share, 0.25e0) * CASE WHEN a.fid IS NULL THEN 1.0e0 ELSE 0.9e0 END AS d,
                        r.qa * coalesce(s.share, 0.25e0) * CASE WHEN a.fid IS NULL THEN 1.0e0 ELSE 0.9e0 END AS dq,
                        coalesce(s.share, 1.0e0) AS percentage_region, CASE WHEN a.fid IS NULL THEN 1.0e0 ELSE 0.9e0 END AS percentage_from_original
                 FROM (SELECT n.fid, x.construction_type, c.id AS dim_date_id, sum(x.quantity) AS q,
                              sum(CASE WHEN day(x.demand_date) % 2 = 0 THEN x.quantity - 20 ELSE 0 END) AS qa
                       FROM (SELECT l_suppkey AS f, construction_type, CAST(l_shipdate AS DATE) AS demand_date, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
                             FROM lineitem JOIN product ON dim_product_id = l_partkey GROUP BY 1, 2, 3) x
                       JOIN factory f ON f.dim_factory_id = x.f AND x.f % 10 <> 1 JOIN named n USING (short_name)
                       JOIN calendar c ON c.full_date = x.demand_date GROUP BY 1, 2, 3) r
                 LEFT JOIN shares s ON s.fid = r.fid LEFT JOIN adj a ON a.fid = r.fid"""),
    ("first", "SELECT year_cw_accounting AS cw, min(id) AS first_id FROM calendar GROUP BY 1"),
    ("weekly", """SELECT dim_factory_id, region, construction_type, first_id AS dim_date_id, sum(d) AS w, sum(dq) AS wq
                  FROM daily JOIN calendar c ON c.id = dim_date_id JOIN first ON cw = c.year_cw_accounting GROUP BY 1, 2, 3, 4"""))
query("l31_daily_capacity", sql("""
SELECT dim_factory_id, region, construction_type, dim_date_id, round(d, 4) AS capacity_raw_daily, round(dq, 4) AS capacity_raw_daily_overwritten,
       percentage_region, percentage_from_original, round(w, 4) AS capacity_raw_weekly, round(wq, 4) AS capacity_raw_weekly_overwritten
FROM daily LEFT JOIN weekly USING (dim_factory_id, region, construction_type, dim_date_id)""", "factory", "product", "calendar", local=_CAP_LOCAL))(l31_daily_capacity)


def l34_capacity_load(spark, sf_dir):
    """L33 weekly grid to rows times share and adjustment, L34 insert or update, L35 second line and clamping; by factory."""
    from ..operators.reshape import pivot_generic
    m = Model(spark, sf_dir)
    helper, adjustment, kinds, mapping, raw = _capacity_inputs(m)
    shares = capacity.region_shares(helper, m.factory)
    daily = capacity.weekly_rollup(capacity.daily_capacity(raw, m.factory, kinds, mapping, shares, adjustment, m.calendar, "ALL", m.parts * len(capacity.REGIONS)), m.calendar)
    weeks = [f"wk{w:02d}" for w in range(1, 54)]
    cal = F.broadcast(m.calendar.select(F.col("id").alias("week_date_id"), F.col("year_accounting").alias("year"),
                                        F.concat(F.lit("wk"), F.right("year_cw_accounting", F.lit(2))).alias("wk")))
    cells = m.capacity.join(cal, "week_date_id").withColumn("cells", F.col("capacity_available_weekly") - 100)
    # capacity comes dealt by factory and type to as many tasks as its lines ask for: the pivot needs no other
    grid = pivot_generic(cells, ["dim_factory_id", "construction_type", "year"], "wk", weeks, "cells")
    weekly = capacity.weekly_grid(grid, weeks, shares, m.factory, adjustment, m.calendar, "ALL", m.parts * len(capacity.REGIONS))
    out = capacity.load_capacity(daily, weekly, m.factory, adjustment)
    figures = ["capacity_raw_weekly", "capacity_raw_daily_overwritten", "capacity_raw_weekly_overwritten", "capacity_available_weekly", "capacity_available_weekly_adjusted"]
    return out.groupBy("dim_factory_id", "region").agg(F.count(F.lit(1)).alias("n_rows"), F.count("capacity_raw_daily").alias("n_raw"),
                                                       *[F.round(F.sum(c), 3).alias(c) for c in figures])


query("l34_capacity_load", sql("""
SELECT dim_factory_id, region, count(*) AS n_rows, count(d) AS n_raw, round(sum(greatest(w, 0)) FILTER (w IS NOT NULL), 3) AS capacity_raw_weekly,
       round(sum(greatest(dq, 0)) FILTER (dq IS NOT NULL), 3) AS capacity_raw_daily_overwritten,
       round(sum(greatest(wq, 0)) FILTER (wq IS NOT NULL), 3) AS capacity_raw_weekly_overwritten, round(sum(greatest(av, 0)), 3) AS capacity_available_weekly,
       round(sum(greatest(av * 0.8e0, 0)) FILTER (adjusted), 3) AS capacity_available_weekly_adjusted
FROM (SELECT coalesce(l.dim_factory_id, g.dim_factory_id) AS dim_factory_id, coalesce(l.region, g.region) AS region, l.d, l.dq, l.w, l.wq,
             CASE WHEN g.dim_factory_id IS NULL THEN 0.0e0 ELSE g.av END AS av, coalesce(l.dim_factory_id, g.dim_factory_id) IN (SELECT fid FROM adj) AS adjusted
      FROM (SELECT * FROM daily LEFT JOIN weekly USING (dim_factory_id, region, construction_type, dim_date_id)) l
      FULL OUTER JOIN (SELECT k.dim_factory_id, coalesce(s.region, 'ALL') AS region, construction_type, first_id AS dim_date_id,
                              max(cells * coalesce(s.share, 0.25e0) * CASE WHEN a.fid IS NULL THEN 1.0e0 ELSE 0.9e0 END) AS av
                       FROM (SELECT dim_factory_id, construction_type, year_cw_accounting, CAST(sum(capacity_available_weekly - 100) AS BIGINT) AS cells
                             FROM capacity JOIN calendar ON week_date_id = id GROUP BY 1, 2, 3) k
                       JOIN first ON cw = year_cw_accounting LEFT JOIN shares s ON s.fid = k.dim_factory_id LEFT JOIN adj a ON a.fid = k.dim_factory_id
                       GROUP BY 1, 2, 3, 4) g USING (dim_factory_id, region, construction_type, dim_date_id)) x
GROUP BY 1, 2""", "factory", "product", "calendar", "capacity", local=_CAP_LOCAL))(l34_capacity_load)
