"""Queries for the projection / filter / scalar-function operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, frames, logic, numbers, text
from .model import Model
from .model_sql import date_id, sql
from .registry import query

RMB_CUSTOMER = "Customer#000000007"  # stands in for the one customer that pays in RMB
QTY_BANDS = [(None, 9, "1 - 9"), (10, 29, "10 - 29"), (30, 39, "30 - 39"), (40, None, ">= 40")]


def p_demand_labels(spark, sf_dir):
    """P01 CASE, P06 band labels, P07 Y/N flags, P16 currency, P17 region-dependent column."""
    m = Model(spark, sf_dir)
    d = (m.demand.join(m.customer, "dim_customer_id")
                 .join(m.product.select("dim_product_id", "material_id", "style_id"), "dim_product_id")
                 .join(m.factory.select(F.col("dim_factory_id").alias("dim_factory_id_original"), "country_code"), "dim_factory_id_original"))
    labelled = d.select(
        logic.band(F.col("quantity"), QTY_BANDS).alias("quantity_band"),
        logic.yes_no("is_edited").alias("edited"),
        logic.currency("customer_name", "country_code", RMB_CUSTOMER, "CN").alias("currency"),
        logic.simple_case("line_status", {"O": "Open", "F": "Shipped"}, "Other").alias("status"),
        F.left(logic.by_region("region", {"EMEA": F.col("material_id")}, F.col("style_id")), F.lit(2)).alias("code_prefix"),
        "quantity")
    return (labelled.groupBy("quantity_band", "edited", "currency", "status", "code_prefix")
                    .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("quantity")))


query("p_demand_labels", sql("""
SELECT CASE WHEN quantity <= 9 THEN '1 - 9' WHEN quantity BETWEEN 10 AND 29 THEN '10 - 29'
            WHEN quantity BETWEEN 30 AND 39 THEN '30 - 39' WHEN quantity >= 40 THEN '>= 40' END AS quantity_band,
       CASE WHEN is_edited = 1 THEN 'Y' ELSE 'N' END AS edited,
       CASE WHEN customer_name = 'Customer#000000007' AND country_code = 'CN' THEN 'RMB' ELSE 'USD' END AS currency,
       CASE line_status WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Shipped' ELSE 'Other' END AS status,
       left(CASE WHEN region = 'EMEA' THEN material_id ELSE style_id END, 2) AS code_prefix,
       count(*) AS n_lines, CAST(sum(quantity) AS BIGINT) AS quantity
FROM demand JOIN customer USING (dim_customer_id) JOIN product USING (dim_product_id)
JOIN factory ON dim_factory_id = dim_factory_id_original
GROUP BY ALL""", "demand", "customer", "product", "factory"))(p_demand_labels)


def p_text_functions(spark, sf_dir):
    """P03 trim/blanks, P05 case-insensitive LIKE, P08 LEN/STUFF/UPPER/CONCAT/+, P13 dash flag,
    P14 product type, P15 derived texts, P39 composite key, P40 material-id corrections."""
    p = Model(spark, sf_dir).product
    pid = F.col("dim_product_id")
    flag_text = F.when(pid % 3 == 0, "-").when(pid % 3 == 1, "Y")
    odd_name = F.when(pid % 11 == 0, F.lit(None)).when(pid % 11 == 1, F.lit("")).otherwise(F.col("style_name"))
    test_material = F.when(pid % 2 == 0, F.concat("material_id", F.lit("P"))).otherwise(F.col("material_id"))
    return p.select(
        "dim_product_id",
        text.strip(F.concat(F.lit("  "), "style_name", F.lit("  "))).alias("trimmed"),
        text.remove_blanks("style_name").alias("no_blanks"),
        text.text_len(F.concat("style_name", F.lit("   "))).alias("name_len"),
        text.stuff("material_id", 1, 2, "XX").alias("stuffed"),
        F.upper("style_name").alias("upper_name"),
        text.concat_nullsafe("style_id", F.lit(None), "construction_type").alias("concat_nullsafe"),
        text.concat_strict("style_id", F.when(pid % 2 == 0, F.lit("x"))).alias("concat_strict"),
        text.dash_flag(flag_text).alias("flag"),
        text.product_type("cat_sub_sbu").alias("product_type"),
        text.gender_new(odd_name).alias("gender_new"),
        text.style_id_erp(F.when(pid % 13 != 0, F.col("material_id"))).alias("style_id_erp"),
        text.style_name_new(odd_name).alias("style_name_new"),
        text.composite_key("material_id", "style_id", "construction_type").alias("composite_key"),
        text.material_cut(F.concat("material_id", F.lit("P01"))).alias("material_cut"),
        text.material_strip_test_suffix(test_material).alias("material_fixed"),
        text.ilike_any("style_name", ["%RING%", "%bolt"]).cast("int").alias("is_ring_or_bolt"),
    )


query("p_text_functions", sql("""
SELECT dim_product_id,
       trim('  ' || style_name || '  ') AS trimmed,
       replace(style_name, ' ', '') AS no_blanks,
       length(rtrim(style_name || '   ')) AS name_len,
       'XX' || substr(material_id, 3) AS stuffed,
       upper(style_name) AS upper_name,
       coalesce(style_id, '') || coalesce(construction_type, '') AS concat_nullsafe,
       style_id || CASE WHEN dim_product_id % 2 = 0 THEN 'x' END AS concat_strict,
       CASE WHEN coalesce(CASE WHEN dim_product_id % 3 = 0 THEN '-' WHEN dim_product_id % 3 = 1 THEN 'Y' END, '-') = '-'
            THEN 0 ELSE 1 END AS flag,
       CASE WHEN cat_sub_sbu ILIKE '%vault%' THEN 'Vault' WHEN cat_sub_sbu ILIKE '%arcad%' THEN 'ArcAd' ELSE 'Regular' END AS product_type,
       CASE WHEN dim_product_id % 11 IN (0, 1) THEN '' ELSE left(style_name, 2) END AS gender_new,
       CASE WHEN dim_product_id % 13 = 0 THEN '' ELSE left(material_id, 8) END AS style_id_erp,
       CASE WHEN dim_product_id % 11 NOT IN (0, 1) THEN substr(style_name, 4) END AS style_name_new,
       concat_ws('-', material_id, style_id, construction_type) AS composite_key,
       substr(material_id || 'P01', 1, 11) AS material_cut,
       CASE WHEN right(tm, 1) = 'P' THEN left(tm, length(tm) - 1) ELSE tm END AS material_fixed,
       CAST(style_name ILIKE '%RING%' OR style_name ILIKE '%bolt' AS INTEGER) AS is_ring_or_bolt
FROM (SELECT *, CASE WHEN dim_product_id % 2 = 0 THEN material_id || 'P' ELSE material_id END AS tm FROM product) p
""", "product"))(p_text_functions)


def p_numeric_text(spark, sf_dir):
    """P09 guarded conversions, P18 pack scaling, P21 numeric text, P38 clamp negatives."""
    o = Model(spark, sf_dir).table("orders")
    k = F.col("o_orderkey")
    amount_text = F.format_number("o_totalprice", 2)
    pct_text = F.concat((k % 100).cast("string"), F.lit("%"))
    date_text = F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("not a date"))
    return o.select(
        k.alias("order_id"),
        numbers.numeric_text_to_double(amount_text).alias("amount"),
        numbers.numeric_text_to_double(pct_text).alias("share"),
        numbers.numeric_text_to_double(F.lit("n/a")).alias("bad_number"),
        numbers.safe_int(F.substring("o_orderpriority", 1, 1)).alias("priority"),
        numbers.safe_int("o_orderpriority").alias("priority_bad"),
        dates.date_id(numbers.safe_date(date_text)).alias("order_date_id"),
        numbers.pack_scaled(F.lit(12), F.when(k % 3 != 0, k % 3)).alias("scaled_qty"),
        numbers.clamp_negative(F.round(F.col("o_totalprice") - 200000, 2)).alias("excess"),
    )


query("p_numeric_text", sql(r"""
SELECT order_id,
       CASE WHEN regexp_matches(amount_text, '^\s*[-+]?[0-9][0-9,]*(\.[0-9]+)?\s*%?\s*$')
            THEN TRY_CAST(regexp_replace(amount_text, '[,\s%]', '', 'g') AS DOUBLE) END AS amount,
       CASE WHEN regexp_matches(pct_text, '^\s*[-+]?[0-9][0-9,]*(\.[0-9]+)?\s*%?\s*$')
            THEN TRY_CAST(regexp_replace(pct_text, '[,\s%]', '', 'g') AS DOUBLE) / 100 END AS share,
       CAST(NULL AS DOUBLE) AS bad_number,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
       TRY_CAST(o_orderpriority AS INTEGER) AS priority_bad,
       """ + date_id("TRY_CAST(date_text AS DATE)") + r""" AS order_date_id,
       CASE WHEN coalesce(scale, 0) = 0 THEN 12 ELSE 12 * scale END AS scaled_qty,
       CASE WHEN round(o_totalprice - 200000, 2) < 0 THEN 0 ELSE round(o_totalprice - 200000, 2) END AS excess
FROM (SELECT o_orderkey AS order_id, o_orderpriority, o_totalprice,
             format('{:,.2f}', o_totalprice) AS amount_text,
             CAST(o_orderkey % 100 AS VARCHAR) || '%' AS pct_text,
             CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'not a date' END AS date_text,
             CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 3 END AS scale
      FROM orders) o"""))(p_numeric_text)

DATE_VARIANTS = ["yyyy-MM-dd", "M/d/yyyy", "dd.MM.yyyy", "yyyyMM", "M-yy"]


def p_dates(spark, sf_dir):
    """P10 date arithmetic and parts, P12 calendar-week labels, P22 date-text normalisation."""
    o = Model(spark, sf_dir).table("orders")
    od = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey")
    variant = None
    for i, fmt in enumerate(DATE_VARIANTS):
        v = F.date_format(od, fmt)
        variant = F.when(k % 5 == i, v) if variant is None else variant.when(k % 5 == i, v)
    return o.select(
        k.alias("order_id"),
        dates.date_id(dates.add_days(od, 73)).alias("plus_73_days"),
        dates.date_id(dates.add_months(od, 11)).alias("plus_11_months"),
        dates.date_id(dates.add_years(od, -1)).alias("minus_1_year"),
        dates.days_between(F.lit("2002-01-01").cast("date"), od).alias("days_to_2002"),
        dates.date_id(dates.month_start(od)).alias("month_start_id"),
        dates.date_id(dates.month_end(od)).alias("month_end_id"),
        dates.weekday_number(od).alias("weekday"),
        dates.weekday_name(od).alias("weekday_name"),
        dates.is_weekend(od).alias("is_weekend"),
        dates.is_month_end(od).alias("is_month_end"),
        dates.date_id(dates.week_start(od)).alias("week_start_id"),
        dates.year_cw(F.year(od), F.ceil(F.dayofyear(od) / 7)).alias("year_cw"),
        dates.cw_week(dates.year_cw(F.year(od), F.ceil(F.dayofyear(od) / 7))).alias("cw_number"),
        dates.date_id(dates.normalize_date_text(variant)).alias("parsed_date_id"),
    )


query("p_dates", sql(f"""
SELECT o_orderkey AS order_id,
       {date_id("od + 73")} AS plus_73_days,
       {date_id("CAST(od + INTERVAL 11 MONTH AS DATE)")} AS plus_11_months,
       {date_id("CAST(od - INTERVAL 1 YEAR AS DATE)")} AS minus_1_year,
       CAST(date_diff('day', od, DATE '2002-01-01') AS INTEGER) AS days_to_2002,
       {date_id("date_trunc('month', od)")} AS month_start_id,
       {date_id("last_day(od)")} AS month_end_id,
       CAST(dayofweek(od) + 1 AS INTEGER) AS weekday,
       dayname(od) AS weekday_name,
       CAST(dayofweek(od) IN (0, 6) AS INTEGER) AS is_weekend,
       CAST(od = last_day(od) AS INTEGER) AS is_month_end,
       {date_id("od - CAST(dayofweek(od) AS INTEGER)")} AS week_start_id,
       CAST(year(od) AS VARCHAR) || 'CW' || lpad(CAST(CAST(ceil(dayofyear(od) / 7) AS BIGINT) AS VARCHAR), 2, '0') AS year_cw,
       CAST(CAST(ceil(dayofyear(od) / 7) AS BIGINT) % 100 AS INTEGER) AS cw_number,
       {date_id("parsed")} AS parsed_date_id
FROM (SELECT o_orderkey, od, CASE WHEN o_orderkey % 5 < 3 THEN od
                                  WHEN o_orderkey % 5 = 3 THEN CAST(date_trunc('month', od) AS DATE)
                                  ELSE make_date(2000 + year(od) % 100, month(od), 1) END AS parsed
      FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS od FROM orders) a) c"""))(p_dates)


def p_frame_cleaning(spark, sf_dir):
    """P19 column names, P20 title case, P24 numeric share, P26 concatenation, P29 reorder, P30
    transcode, P31 repeated header rows -- on the customer table turned into loader-style text."""
    c = Model(spark, sf_dir).table("customer")
    raw = c.select(F.col("c_custkey").cast("string").alias("Customer Key#"),
                   F.col("c_mktsegment").alias("Market Segment"),
                   F.lower(F.col("c_mktsegment")).alias("Segment (code)"),
                   F.col("c_acctbal").cast("string").alias("Account Balance"))
    # the same table with a repeated header row per nation, as files glued together carry them
    headers = c.select("c_nationkey").distinct().select(
        F.lit("Customer Key#").alias("Customer Key#"), F.lit("Market Segment").alias("Market Segment"),
        F.lit("Segment (code)").alias("Segment (code)"), F.lit("Account Balance").alias("Account Balance"))
    glued = raw.unionByName(headers)
    clean = frames.normalize_column_names(frames.remove_header_rows(glued))
    clean = frames.title_case(clean, ["segment_code"])
    clean = frames.transcode(clean, "market_segment", {"BUILDING": "B", "MACHINERY": "M", "AUTOMOBILE": "A",
                                                       "FURNITURE": "F"}, out="segment_letter")
    clean = frames.concat_columns(clean, ["segment_letter", "customer_key"], "tag", sep="/")
    clean = frames.convert_numeric(clean, ["account_balance"])
    return frames.reorder(clean, ["customer_key", "tag"])


query("p_frame_cleaning", sql("""
SELECT customer_key, tag, market_segment, segment_code, account_balance, segment_letter
FROM (SELECT CAST(c_custkey AS VARCHAR) AS customer_key, c_mktsegment AS market_segment,
             upper(left(lower(c_mktsegment), 1)) || substr(lower(c_mktsegment), 2) AS segment_code,
             c_acctbal AS account_balance,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' WHEN 'AUTOMOBILE' THEN 'A'
                               WHEN 'FURNITURE' THEN 'F' END AS segment_letter
      FROM customer) c
CROSS JOIN LATERAL (SELECT coalesce(segment_letter, '') || '/' || customer_key AS tag) t"""))(p_frame_cleaning)
