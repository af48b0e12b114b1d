"""Queries for reports and checks over the demand view (R01-R04, R07, R08, R12-R14, R17, R19, V04, V07, V08, V11, V12), for
the calendar's attributes (D02-D06) and for the remaining scalar and frame functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, frames, logic, numbers, text
from ..operators import calendar as cal_ops
from ..operators import kpi, lookups, merge, reshape, validate
from .model import Model
from .model_sql import sql
from .q_reports import _run_date
from .registry import query

# ------------------------------------------------------------------------------------------------ R01-R04
SIGNALS = ["Forecast - Bulk Buy", "Forecast - Retail Quick Turn", "Need to Buy - Bulk Buy", "Need to Buy - Retail Quick Turn",
           "Need to Buy - Scheduled Out of Sync", "Need to Buy - Ad-Hoc Out of Sync", "Open Order", "Shipped Order"]


def r01_demand_view(spark, sf_dir):
    """R01 demand with its roles (product, customer, first-priority and original factory, demand and release day), R02
    reallocated flag, R03 flags, currency and the regional vendor code."""
    m = Model(spark, sf_dir)
    d = m.demand.join(m.priority, "dim_product_id", "left").withColumn("release_date_id", dates.date_id("release_date"))
    cal = F.broadcast(m.calendar)
    v = lookups.star_join(d, [
        (m.product, "dim_product_id", "dim_product_id", "product", ["material_id", "style_id", "construction_type", "cat_sub_sbu"]),
        (m.customer, "dim_customer_id", "dim_customer_id", "customer", ["customer_name", "region", "sold_to_party"]),
        (m.factory, "dim_factory_id_1", "dim_factory_id", "first", ["short_name", "country_code", "vendor_group"]),
        (m.factory, "dim_factory_id_original", "dim_factory_id", "original", ["short_name", "country_code"]),
        (cal, "dim_date_id", "id", "demand", ["year_cw_accounting", "season_year_buy"]),
        (cal, "release_date_id", "id", "release", ["year_month_accounting"])])
    moved = F.col("dim_factory_id_1") != F.col("dim_factory_id_original")
    return v.select("order_id", "line_id", "product_material_id", "customer_region", "first_short_name", "original_short_name",
                    "demand_year_cw_accounting", "demand_season_year_buy", "release_year_month_accounting", "quantity",
                    F.when(moved, 1).otherwise(0).alias("is_reallocated"), logic.yes_no("is_edited").alias("edited"),
                    logic.currency("customer_customer_name", "first_country_code", "Customer#000000007", "CN").alias("currency"),
                    logic.by_region("customer_region", {"EMEA": F.concat(F.lit("E-"), "first_vendor_group"), "APAC": F.concat(F.lit("A-"), "first_vendor_group")},
                                    F.col("first_vendor_group")).alias("vendor_code"))


query("r01_demand_view", sql("""
SELECT d.order_id, d.line_id, p.material_id AS product_material_id, c.region AS customer_region, f1.short_name AS first_short_name,
       f0.short_name AS original_short_name, cd.year_cw_accounting AS demand_year_cw_accounting, cd.season_year_buy AS demand_season_year_buy,
       cr.year_month_accounting AS release_year_month_accounting, d.quantity,
       CASE WHEN pr.dim_factory_id_1 <> d.dim_factory_id_original THEN 1 ELSE 0 END AS is_reallocated,
       CASE WHEN is_edited = 1 THEN 'Y' ELSE 'N' END AS edited,
       CASE WHEN c.customer_name = 'Customer#000000007' AND f1.country_code = 'CN' THEN 'RMB' ELSE 'USD' END AS currency,
       CASE c.region WHEN 'EMEA' THEN 'E-' WHEN 'APAC' THEN 'A-' ELSE '' END || f1.vendor_group AS vendor_code
FROM demand d LEFT JOIN priority pr USING (dim_product_id) LEFT JOIN product p USING (dim_product_id) LEFT JOIN customer c USING (dim_customer_id)
LEFT JOIN factory f1 ON f1.dim_factory_id = pr.dim_factory_id_1 LEFT JOIN factory f0 ON f0.dim_factory_id = d.dim_factory_id_original
LEFT JOIN calendar cd ON cd.id = d.dim_date_id
LEFT JOIN calendar cr ON cr.id = year(release_date) * 10000 + month(release_date) * 100 + day(release_date)""",
    "demand", "priority", "product", "customer", "factory", "calendar"))(r01_demand_view)


def r04_demand_pivot(spark, sf_dir):
    """R04 demand by signal type and buying program in eight columns, per product, day, factory, customer and order."""
    d = Model(spark, sf_dir).demand
    signal = F.when(F.col("demand_category") == "Order", F.when(F.col("line_status") == "O", "Open Order").otherwise("Shipped Order")
                    ).otherwise(F.concat_ws(" - ", "demand_category", "buying_program"))
    ids = ["dim_product_id", "dim_date_id", "dim_factory_id_original", "dim_customer_id", "order_id"]
    return reshape.pivot_sum(d.withColumn("signal", signal), ids, "signal", SIGNALS, "quantity")


query("r04_demand_pivot", sql("SELECT dim_product_id, dim_date_id, dim_factory_id_original, dim_customer_id, order_id, " + ", ".join(
    f"CAST(coalesce(sum(quantity) FILTER (" + (
        f"demand_category = '{s.split(' - ')[0]}' AND buying_program = '{s.split(' - ')[1]}'" if " - " in s
        else "demand_category = 'Order' AND line_status " + ("= 'O'" if s == "Open Order" else "<> 'O'")) + f"), 0) AS BIGINT) AS \"{s}\"" for s in SIGNALS)
    + " FROM demand GROUP BY 1, 2, 3, 4, 5", "demand"))(r04_demand_pivot)


# ------------------------------------------------------------------------------------------------ R07, R08, R12-R14, R17, R19
def r07_alternative_volumes(spark, sf_dir):
    """R07 the ten factories that give away and that receive the most volume where another than the first-priority factory
    produces."""
    m = Model(spark, sf_dir)
    d = m.lines.join(m.priority, "dim_product_id").select(F.col("dim_factory_id_1").alias("dim_factory_id"),
                                                          F.col("dim_factory_id_original").alias("dim_factory_alternative_id"), "quantity")
    return kpi.alternative_volumes(d, m.factory, 10)


def _r07_side(col, kind):
    return f"""SELECT factory_short_name, quantity, '{kind}' AS report_type, CAST(dense_rank() OVER (ORDER BY quantity DESC) AS INTEGER) AS ranking
      FROM (SELECT f.short_name AS factory_short_name, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem JOIN priority p ON p.dim_product_id = l_partkey
            JOIN factory f ON f.dim_factory_id = {col} WHERE p.dim_factory_id_1 <> l_suppkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) t"""


query("r07_alternative_volumes", sql(_r07_side("p.dim_factory_id_1", "Going-Out") + " UNION ALL " + _r07_side("l_suppkey", "Coming-In"),
                                     "priority", "factory"))(r07_alternative_volumes)


def r08_capacity_change(spark, sf_dir):
    """R08/A09 the five factories with the largest average change of monthly capacity between two releases (the second one
    here changes weekly figures by an amount of the week and the factory)."""
    m = Model(spark, sf_dir)
    cal = F.broadcast(m.calendar.select(F.col("id").alias("week_date_id"), "year_month_accounting"))
    cap = m.capacity.join(cal, "week_date_id").join(m.factory.select("dim_factory_id", "short_name"), "dim_factory_id")
    moved = F.col("capacity_available_weekly") + (F.col("week_date_id") % 11) * 5 - (F.col("dim_factory_id") % 7) * 5
    both = cap.withColumn("release", F.lit(1)).unionByName(cap.withColumn("release", F.lit(2)).withColumn("capacity_available_weekly", moved))
    out = kpi.capacity_change(both, "release", "year_month_accounting", "short_name", 5)
    return out.withColumn("average_discrepancy", F.round("average_discrepancy", 6))


query("r08_capacity_change", sql("""
SELECT short_name, round(a, 6) AS average_discrepancy, mx AS max_discrepancy, 'TOP' AS report_type, CAST(dense_rank() OVER (ORDER BY a DESC) AS INTEGER) AS ranking
FROM (SELECT short_name, avg(r) AS a, max(r) AS mx FROM (
        SELECT year_month_accounting, short_name, CAST(abs(sum((week_date_id % 11) * 5 - (dim_factory_id % 7) * 5)) AS BIGINT) AS r
        FROM capacity JOIN calendar ON id = week_date_id JOIN factory USING (dim_factory_id) GROUP BY 1, 2) x
      GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5) t""", "capacity", "calendar", "factory"))(r08_capacity_change)


def r12_most_demanded_models(spark, sf_dir):
    """R12 the ten most demanded models (construction type and brand) per horizon."""
    m = Model(spark, sf_dir)
    d = m.lines.withColumn("horizon", kpi.horizon_of(F.col("demand_date"), F.lit(_run_date(m)))).filter(F.col("horizon").isNotNull())
    return kpi.most_demanded(d, m.product.withColumn("model", F.concat_ws("/", "style_id", "construction_type")), "model", n=10)


query("r12_most_demanded_models", sql("""
SELECT horizon, model, volume, CAST(dense_rank() OVER (PARTITION BY horizon ORDER BY volume DESC) AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY volume DESC, model) AS rn
      FROM (SELECT CASE WHEN k <= 2 THEN 1 WHEN k <= 5 THEN 2 ELSE 3 END AS horizon, p_brand || '/' || p_type AS model, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume
            FROM (SELECT *, (year(l_shipdate) - year(r)) * 12 + month(l_shipdate) - month(r) AS k FROM lineitem, run) l JOIN part ON p_partkey = l_partkey
            WHERE k >= 0 GROUP BY 1, 2) a) b WHERE rn <= 10""",
    local=(("run", "SELECT CAST(date_trunc('month', max(o_orderdate)) - INTERVAL 24 MONTH AS DATE) AS r FROM orders"),)))(r12_most_demanded_models)


def r13_volume_checks(spark, sf_dir):
    """R13 volume by 'ASAP' or month and region, and by month and factory, from one aggregate."""
    m = Model(spark, sf_dir)
    when = F.when(F.datediff("demand_date", "release_date") < 30, "ASAP").otherwise(F.date_format("demand_date", "yyyy-MM"))
    per = (m.demand.groupBy("dim_customer_id", "dim_factory_id_original", when.alias("due"), F.date_format("demand_date", "yyyy-MM").alias("month"))
            .agg(F.sum("quantity").alias("quantity"))
            .join(m.customer.select("dim_customer_id", "region"), "dim_customer_id")
            .join(m.factory.select(F.col("dim_factory_id").alias("dim_factory_id_original"), "short_name"), "dim_factory_id_original"))
    sets = F.explode(F.array(F.struct(F.lit("due_region").alias("summary"), F.col("due").alias("k1"), F.col("region").alias("k2")),
                             F.struct(F.lit("month_factory").alias("summary"), F.col("month").alias("k1"), F.col("short_name").alias("k2"))))
    return per.select(sets.alias("s"), "quantity").groupBy("s.summary", "s.k1", "s.k2").agg(F.sum("quantity").alias("quantity"))


query("r13_volume_checks", sql("""
SELECT 'due_region' AS summary, CASE WHEN date_diff('day', release_date, demand_date) < 30 THEN 'ASAP' ELSE strftime(demand_date, '%Y-%m') END AS k1, region AS k2,
       CAST(sum(quantity) AS BIGINT) AS quantity FROM demand JOIN customer USING (dim_customer_id) GROUP BY 1, 2, 3
UNION ALL
SELECT 'month_factory', strftime(demand_date, '%Y-%m'), short_name, CAST(sum(quantity) AS BIGINT)
FROM demand JOIN factory ON dim_factory_id = dim_factory_id_original GROUP BY 1, 2, 3""", "demand", "customer", "factory"))(r13_volume_checks)


def r14_reconciliation(spark, sf_dir):
    """R14 source against fact by month: the staged lines (all) and the loaded ones (known products, one line a sixth left
    out), full outer, with the difference."""
    m = Model(spark, sf_dir)
    month = F.date_format("demand_date", "yyyy-MM").alias("month")
    src = m.lines.filter("order_id % 5 != 0").groupBy(month).agg(F.sum("quantity").alias("source_quantity"), F.count(F.lit(1)).alias("source_rows"))
    fact = m.lines.filter("line_id != 6").join(m.product.select("dim_product_id"), "dim_product_id", "left_semi").groupBy(month).agg(
        F.sum("quantity").alias("fact_quantity"), F.count(F.lit(1)).alias("fact_rows"))
    return src.join(fact, "month", "full_outer").withColumn("difference", F.coalesce("fact_quantity", F.lit(0)) - F.coalesce("source_quantity", F.lit(0)))


query("r14_reconciliation", sql("""
SELECT strftime(l_shipdate, '%Y-%m') AS month, CAST(sum(q) FILTER (s) AS BIGINT) AS source_quantity, nullif(count(*) FILTER (s), 0) AS source_rows,
       CAST(sum(q) FILTER (f) AS BIGINT) AS fact_quantity, nullif(count(*) FILTER (f), 0) AS fact_rows,
       CAST(coalesce(sum(q) FILTER (f), 0) - coalesce(sum(q) FILTER (s), 0) AS BIGINT) AS difference
FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q, l_orderkey % 5 <> 0 AS s, l_linenumber <> 6 AND l_partkey IN (SELECT p_partkey FROM part) AS f FROM lineitem) x
WHERE s OR f GROUP BY 1"""))(r14_reconciliation)


def r17_comments(spark, sf_dir):
    """R17 distinct comments (here the order priority with the sold-to party) of the current release's slice."""
    m = Model(spark, sf_dir)
    last = lookups.scalar(m.table("orders").agg(F.max(F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("r")))["r"]
    d = m.demand.filter(F.col("dim_release_id") == F.lit(last)).join(m.customer.select("dim_customer_id", "sold_to_party"), "dim_customer_id")
    return d.select(F.concat_ws(": ", "buying_program", "sold_to_party").alias("comment")).distinct()


query("r17_comments", sql("""
SELECT DISTINCT concat_ws(': ', buying_program, sold_to_party) AS comment FROM demand JOIN customer USING (dim_customer_id)
WHERE dim_release_id = (SELECT max(year(o_orderdate) * 100 + month(o_orderdate)) FROM orders)""", "demand", "customer"))(r17_comments)


def r19_unmatched_weeks(spark, sf_dir):
    """R19 week labels of the staged orders that no calendar week has, with their rows."""
    m = Model(spark, sf_dir)
    o = m.table("orders")
    label = F.concat(F.year("o_orderdate").cast("string"), F.lit("CW"), text.pad_key(F.weekofyear("o_orderdate") + (F.col("o_orderkey") % 3).cast("int"), 2))
    staged = o.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return lookups.anti(staged, m.calendar.select(F.col("year_cw_accounting").alias("label")).distinct(), "label")


query("r19_unmatched_weeks", sql("""
SELECT label, n FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) || 'CW' || lpad(CAST(weekofyear(o_orderdate) + o_orderkey % 3 AS VARCHAR), 2, '0') AS label, count(*) AS n
                      FROM orders GROUP BY 1) s WHERE label NOT IN (SELECT year_cw_accounting FROM calendar)""", "calendar"))(r19_unmatched_weeks)


# ------------------------------------------------------------------------------------------------ validation suites
def v10_suites(spark, sf_dir):
    """V04 materials missing in the priority list, V07 overrides without a comment, V08 unknown factories, V11 forecast
    and V12 capacity checks, as one suite of findings by source."""
    m = Model(spark, sf_dir)
    k = F.col("order_id")
    d = m.demand.join(m.product.select("dim_product_id", "material_id"), "dim_product_id")
    prio = m.product.filter("dim_product_id % 17 != 3").select("material_id")
    decisions = m.lines.select("order_id", F.when(k % 3 == 0, F.lit("moved")).alias("comment"),
                               F.concat(F.lit("F"), ((k * 7) % 120).cast("string")).alias("code"), (k % 2 == 0).alias("changed"))
    codes = m.factory.select(F.concat(F.lit("F"), F.col("dim_factory_id").cast("string")).alias("code"))
    seasons = m.calendar.select("season_year_short_buy", "month_name_short_accounting").distinct()
    plan = m.lines.select(F.concat(F.lit("SP"), F.date_format("demand_date", "yy")).alias("season"), F.date_format("demand_date", "MMM").alias("month"))
    grid = m.capacity.select("construction_type", (F.floor(F.col("week_date_id") / 10000) + 15).cast("string").alias("year"))
    return validate.run_suite([
        *[validate.missing_in(d.filter(F.col("demand_category") == c), ["material_id"], prio, ["material_id"], s, "Not in the priority list")
          for c, s in (("Need to Buy", "NTB"), ("Forecast", "Forecast"))],
        validate.override_without_comment(decisions, F.col("changed"), "comment", "order_id", "Decisions"),
        validate.missing_in(decisions, ["code"], codes, ["code"], "Decisions", "Factory missing"),
        validate.missing_in(plan, ["season", "month"], seasons, ["season_year_short_buy", "month_name_short_accounting"], "Forecast", "Season/month missing"),
        validate.not_in_list(grid, "construction_type", ["STANDARD", "MEDIUM", "ECONOMY", "PROMO", "LARGE"], "Capacity", "Construction type invalid"),
        validate.not_in_list(grid, "year", [str(y) for y in range(2010, 2051)], "Capacity", "Year invalid")], system="DEMAND")


query("v10_suites", sql("""
SELECT DISTINCT 'DEMAND' AS system, source, category, value FROM (
  SELECT CASE demand_category WHEN 'Need to Buy' THEN 'NTB' ELSE 'Forecast' END AS source, 'Not in the priority list' AS category, material_id AS value
  FROM demand JOIN product USING (dim_product_id) WHERE demand_category IN ('Need to Buy', 'Forecast') AND dim_product_id % 17 = 3
  UNION ALL SELECT 'Decisions', 'Override without comment', CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_orderkey % 2 = 0 AND l_orderkey % 3 <> 0
  UNION ALL SELECT 'Decisions', 'Factory missing', 'F' || CAST(l_orderkey * 7 % 120 AS VARCHAR) FROM lineitem WHERE l_orderkey * 7 % 120 NOT IN (SELECT s_suppkey FROM supplier)
  UNION ALL SELECT 'Forecast', 'Season/month missing', s || '/' || mo FROM (SELECT 'SP' || strftime(l_shipdate, '%y') AS s, strftime(l_shipdate, '%b') AS mo FROM lineitem) l
    WHERE (s, mo) NOT IN (SELECT (season_year_short_buy, month_name_short_accounting) FROM calendar)
  UNION ALL SELECT 'Capacity', 'Construction type invalid', construction_type FROM capacity WHERE construction_type NOT IN ('STANDARD', 'MEDIUM', 'ECONOMY', 'PROMO', 'LARGE')
  UNION ALL SELECT 'Capacity', 'Year invalid', CAST(week_date_id // 10000 + 15 AS VARCHAR) FROM capacity WHERE week_date_id // 10000 + 15 NOT BETWEEN 2010 AND 2050) x""",
    "demand", "product", "calendar", "capacity"))(v10_suites)


# ------------------------------------------------------------------------------------------------ calendar
def d02_calendar(spark, sf_dir):
    """D02-D04 season systems and attributes of every calendar day that orders have, D06 the month two periods before, J09
    the period's first day."""
    m = Model(spark, sf_dir)
    days = m.table("orders").select(dates.date_id("o_orderdate").alias("id")).distinct()
    first = cal_ops.period_start(m.calendar, "year_month_accounting")
    c = m.calendar.join(days, "id", "left_semi").join(first, "year_month_accounting")
    return c.select("id", "season_buy", "season_crd", "season_intro", "season_year_short_buy", "season_year_short_crd", "season_year_short_intro", "season_year_buy",
                    "season_year_crd", "season_year_intro", "month_name_accounting", "day_of_week", "day_name_of_week", "is_last_day_of_month", "is_weekend_day",
                    cal_ops.minus_periods(F.col("year_month_accounting"), 2).alias("two_before"), "period_start_id")


query("d02_calendar", sql("""
SELECT id, season_buy, season_crd, season_intro, season_year_short_buy, season_year_short_crd, season_year_short_intro, season_year_buy, season_year_crd, season_year_intro,
       month_name_accounting, day_of_week, day_name_of_week, is_last_day_of_month, is_weekend_day,
       CASE WHEN period_accounting > 2 THEN CAST(year_accounting AS VARCHAR) || '-' || lpad(CAST(period_accounting - 2 AS VARCHAR), 2, '0')
            ELSE CAST(year_accounting - 1 AS VARCHAR) || '-' || lpad(CAST(period_accounting + 10 AS VARCHAR), 2, '0') END AS two_before,
       (SELECT min(id) FROM calendar x WHERE x.year_month_accounting = c.year_month_accounting) AS period_start_id
FROM calendar c WHERE id IN (SELECT year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) FROM orders)""", "calendar"))(d02_calendar)


def d05_calendar_upsert(spark, sf_dir):
    """D05 upsert of the calendar: days already there (those with orders, with an old name) take the new values, others are
    added."""
    m = Model(spark, sf_dir)
    new = m.calendar.select("id", "day_name_of_week", "is_weekend_day")
    old = m.table("orders").select(dates.date_id("o_orderdate").alias("id")).distinct().select("id", F.lit("old").alias("day_name_of_week"), F.lit(9).alias("is_weekend_day"),
                                                                                             F.lit("kept").alias("note"))
    return merge.upsert(old, new, ["id"]).groupBy("note", "day_name_of_week", "is_weekend_day").agg(F.count(F.lit(1)).alias("n"))


query("d05_calendar_upsert", sql("""
SELECT CASE WHEN o.id IS NOT NULL THEN 'kept' END AS note, day_name_of_week, is_weekend_day, count(*) AS n
FROM calendar c LEFT JOIN (SELECT DISTINCT year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS id FROM orders) o USING (id)
GROUP BY 1, 2, 3""", "calendar"))(d05_calendar_upsert)


# ------------------------------------------------------------------------------------------------ scalars and frames
def p04_guards(spark, sf_dir):
    """P02 first non-null, P04 NOT IN with NULLs, P07 ASAP label, P11 percent text, P27 display numbers, P37 defaults, J04
    rows that nothing resolves drop out."""
    o = Model(spark, sf_dir).table("orders")
    k = F.col("o_orderkey")
    status = F.when(k % 7 != 0, F.col("o_orderstatus"))
    kept = o.withColumn("status", status).filter(logic.not_in("status", ["P", "X"]))
    known = kept.select("o_custkey").distinct().filter("o_custkey % 3 = 0").select(F.col("o_custkey").alias("c"), (F.col("o_custkey") * 2).alias("id"))
    r = lookups.resolve(kept, [(known, [("o_custkey", "c")], "id")], "resolved", drop_unresolved=True)
    out = r.select(k.alias("order_id"), logic.first_non_null(F.when(k % 5 == 0, k), F.when(k % 2 == 0, F.lit(-2).cast("bigint")), F.lit(-1).cast("bigint")).alias("chosen"),
                   logic.asap_label((k % 2).cast("int"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("due"),
                   numbers.percent_text((k % 400) / 100).alias("share"), logic.default_if_null(F.when(k % 3 == 0, "x"), "NA").alias("kind"),
                   F.col("o_custkey").alias("amount"), ((k % 100) / 100).alias("pct"), "resolved")
    return frames.display_numbers(out, ["amount", "pct"], percent=("pct",))


query("p04_guards", sql("""
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey WHEN o_orderkey % 2 = 0 THEN -2 ELSE -1 END AS chosen,
       CASE WHEN o_orderkey % 2 = 1 THEN 'ASAP' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS due, format('{:,.2f}%', (o_orderkey % 400) * 1.0::DOUBLE) AS share,
       CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE 'NA' END AS kind, format('{:,}', o_custkey) AS amount, format('{:,.2f}%', (o_orderkey % 100) * 1.0::DOUBLE) AS pct,
       o_custkey * 2 AS resolved
FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderstatus NOT IN ('P', 'X') AND o_custkey % 3 = 0"""))(p04_guards)


def p23_profile(spark, sf_dir):
    """P23 date-layout votes, P24 numeric share, P25 whether 64 bits are needed, P28 columns without a value, one row each."""
    m = Model(spark, sf_dir)
    o, k = m.table("orders"), F.col("o_orderkey")
    raw = o.select(F.when(k % 3 == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("a"),
                   F.when(k % 4 != 0, F.date_format("o_orderdate", "dd.MM.yyyy")).alias("b"), F.when(k % 5 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("n"),
                   (k * 1000000).alias("big"), F.lit(None).cast("string").alias("nothing"))
    votes = dates.date_format_votes(raw, ["a", "b"]).select(F.concat_ws("|", F.lit("P23"), "column", "layout").alias("item"), F.col("votes").cast("double").alias("value"))
    share = frames.numeric_columns(raw, ["n"]).select(F.lit("P24|n").alias("item"), F.round("n", 6).alias("value"))
    wide = frames.storage_types(raw, ["big"]).select(F.lit("P25|big").alias("item"), F.col("big").cast("int").cast("double").alias("value"))
    left = frames.drop_all_null(raw)
    kept = left.agg(F.count(F.lit(1)).alias("n")).select(F.lit("P28|" + ",".join(left.columns)).alias("item"), F.col("n").cast("double").alias("value"))
    return votes.unionByName(share).unionByName(wide).unionByName(kept)


query("p23_profile", sql("""
SELECT 'P23|' || c || '|' || l AS item, CAST(v AS DOUBLE) AS value FROM (
  SELECT 'a' AS c, u.l, CASE u.l WHEN 'DATE_US' THEN count(*) FILTER (o_orderkey % 3 = 0) WHEN 'DATE_EU' THEN count(*) FILTER (o_orderkey % 3 = 0 AND day(o_orderdate) <= 12)
                       WHEN 'DATE_ISO' THEN count(*) FILTER (o_orderkey % 3 <> 0) ELSE 0 END AS v
  FROM orders, (VALUES ('DATE_US'), ('DATE_EU'), ('DATE_ISO'), ('MONTH_DATE'), ('MONTH_DATE_ISO')) u(l) GROUP BY 1, 2
  UNION ALL SELECT 'b', u.l, CASE u.l WHEN 'DATE_EU' THEN count(*) FILTER (o_orderkey % 4 <> 0) ELSE 0 END
  FROM orders, (VALUES ('DATE_US'), ('DATE_EU'), ('DATE_ISO'), ('MONTH_DATE'), ('MONTH_DATE_ISO')) u(l) GROUP BY 1, 2) x
UNION ALL SELECT 'P24|n', round(count(*) FILTER (o_orderkey % 5 <> 0) / count(*), 6) FROM orders
UNION ALL SELECT 'P25|big', CAST(max(o_orderkey) * 1000000 > 1000000000 AS DOUBLE) FROM orders
UNION ALL SELECT 'P28|a,b,n,big', CAST(count(*) AS DOUBLE) FROM orders"""))(p23_profile)


def p34_patterns(spark, sf_dir):
    """P34 the longest word of a product's type that its name holds, J18 the largest retail price of a smaller product of
    the same brand and type."""
    m = Model(spark, sf_dir)
    p = m.table("part")
    words = p.select(F.explode(F.split("p_name", " ")).alias("pattern")).distinct().filter(F.length("pattern") > 4)
    longest = frames.longest_pattern(p.select(F.col("p_name").alias("path")).distinct(), words)
    rules = p.select(F.col("p_brand").alias("b"), F.col("p_type").alias("t"), F.col("p_size").alias("s"), F.col("p_retailprice").alias("price"))
    best = lookups.correlated_max(p, rules, [("p_brand", "b"), ("p_type", "t")], ("p_size", "s"), F.col("price"), "best_smaller")
    return best.join(longest, best["p_name"] == longest["path"]).select("p_partkey", "matched_pattern", "best_smaller")


query("p34_patterns", sql("""
SELECT p.p_partkey, (SELECT max(w) FROM (SELECT w, length(w) AS n, max(length(w)) OVER () AS most FROM unnest(string_split(p.p_name, ' ')) u(w) WHERE length(w) > 4) x WHERE n = most) AS matched_pattern,
       q.best AS best_smaller
FROM part p LEFT JOIN (SELECT a.p_partkey, max(b.p_retailprice) AS best FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND b.p_size < a.p_size
                       GROUP BY 1) q USING (p_partkey)"""))(p34_patterns)
