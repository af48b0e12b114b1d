"""Demand loads (L02-L04, L10-L13, L20, L21): regional need-to-buy rows, forecasts, ERP orders, from staged text to facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import add_days, add_months, date_id
from ..functions.numbers import safe_date
from .lookups import dedup_lookup, resolve, week_from_text

# fixed values: days from the release to an ASAP date, usual and for materials of the long lead time.
ASAP_DAYS, ASAP_DAYS_LONG, LONG_LEAD_TIME = 73, 103, 110
UNDEFINED = "UNDEFINED"


def resolve_product(staged: DataFrame, products: DataFrame, materials: DataFrame, width: int = 11) -> DataFrame:
    """The product by (material cut to ``width`` characters, size), else the material's placeholder, else the row drops
    out.  ``products``: (material_id, size, id); ``materials``: (material_id, id) and further columns, whose largest values
    the rows are given.  Sizes and placeholder of a material are one row of the lookup, so the staged rows are dealt once."""
    more = [c for c in materials.columns if c not in ("material_id", "id")]
    sized = products.filter(F.col("material_id").isNotNull() & F.col("size").isNotNull()).groupBy("material_id", "size").agg(F.max("id").alias("id"))
    sizes = sized.groupBy("material_id").agg(F.map_from_entries(F.collect_list(F.struct("size", "id"))).alias("_sizes"))
    known = materials.groupBy("material_id").agg(F.max("id").alias("_placeholder"), *[F.max(c).alias(c) for c in more]).join(sizes, "material_id", "full")
    known = known.withColumnRenamed("material_id", "_mtl")
    found = staged.withColumn("_mtl", F.substring("material_id", 1, width)).join(known, "_mtl")
    found = found.withColumn("dim_product_id", F.coalesce(F.try_element_at("_sizes", F.col("size")), F.col("_placeholder")))
    return found.filter(F.col("dim_product_id").isNotNull()).drop("_mtl", "_sizes", "_placeholder")


def _facts(df: DataFrame, order: Column, date: Column, asap: Column, whole: dict[str, Column] | None = None) -> DataFrame:
    """Facts by order number, date, customer, product and ASAP.  With ``whole`` (fact column -> aggregate of staged columns)
    they carry both quantities (``quantity`` in units, ``sap_quantity`` as the order system has it), the original date and
    those attributes; a text's maximum makes that aggregate sort by the key instead of hashing it."""
    keys = {"order_number": order, "dim_date_id": date, "dim_customer_id": F.col("dim_customer_id"), "dim_product_id": F.col("dim_product_id"), "is_asap": asap}
    grouped = df.groupBy(*[c.alias(n) for n, c in keys.items()])
    if whole is None:
        return grouped.agg(F.sum("quantity").alias("quantity"))
    out = grouped.agg(F.sum("quantity").alias("quantity_lum"), F.sum("sap_quantity").alias("quantity_non_lum"), *[c.alias(n) for n, c in whole.items()])
    return out.withColumn("dim_date_id_original", F.col("dim_date_id"))


#: The attributes of a fact that come from the staged rows, in order; a region that has none leaves NULL.
ATTRIBUTES = {n: "string" for n in ("material_id_sr", "pr_code", "pr_cut_code", "so_code", "po_code_customer", "comment_region", "sold_to_customer_name", "musical_cnt",
                                    "smu", "order_reference", "sku_footlocker", "prepack_code", "exp_delivery_with_constraint", "exp_delivery_without_constraint",
                                    "coo", "remarks_region")} | {"mcq": "int", "carton_qty": "int", "delivery_d": "date", "customer_requested_xf_dt": "date",
                                                                  "original_customer_requested_dt": "date"}


def region_attributes(region: str) -> dict[str, Column]:
    """Fact column -> aggregate of the region's staged columns: the largest value of a group, missing codes as empty text
    where the region's load has them so."""
    def top(c):
        return F.max(c)

    def filled(c):
        return F.max(F.coalesce(c, F.lit("")))

    given = {
        "EMEA": {"material_id_sr": top("staged_material_id"), "pr_code": filled("pr_code"), "so_code": top("so_code"), "sold_to_customer_name": top("sold_party"),
                 "mcq": top("moq"), **{n: top(n) for n in ("smu", "order_reference", "sku_footlocker", "prepack_code")},
                 "exp_delivery_with_constraint": top("exp_delivery_with_constraint"), "exp_delivery_without_constraint": top("delivery_text"),
                 "coo": top("location_country"), "remarks_region": top("comment_region")},
        "APAC": {"material_id_sr": top("staged_material_id"), "pr_code": filled("pr_code"), "pr_cut_code": filled("item"), "so_code": top("so_code"),
                 "po_code_customer": top("customer_po_code"), "comment_region": top("comment_region"), "customer_requested_xf_dt": top("requested"),
                 "original_customer_requested_dt": top("requested"), "sold_to_customer_name": top("ship_name"), "mcq": top("moq"), "musical_cnt": top("musical_cnt"),
                 "remarks_region": top("remarks"), "carton_qty": top("carton_qty")},
        "CASA": {"material_id_sr": top("staged_material_id"), "pr_code": F.coalesce(top("pr_code"), F.lit(UNDEFINED)), "po_code_customer": top("customer_po_code"),
                 "comment_region": top("comment_region"), "customer_requested_xf_dt": top("_d"), "original_customer_requested_dt": top("_d"),
                 "sold_to_customer_name": F.lit("CASA"), "mcq": top("moq"), **{n: top(n) for n in ("smu", "order_reference", "sku_footlocker", "prepack_code")},
                 "coo": top("country_origin"), "remarks_region": top("comment_region")},
        "NORA": {"material_id_sr": filled("staged_material_id"), "pr_code": filled("pr_code"), "pr_cut_code": filled("item"), "so_code": filled("so_code"),
                 "po_code_customer": filled("customer_po_code"), "comment_region": filled("planning_notes"), "customer_requested_xf_dt": top("_d"),
                 "original_customer_requested_dt": top("required"), "sold_to_customer_name": filled("sold_party"),
                 "mcq": F.when(F.length(top("staged_material_id")) == 11, 1).otherwise(F.right(top("size"), F.lit(2)).try_cast("int")),
                 "delivery_d": safe_date(top("delivered")), "smu": top("smu")},
    }[region]
    return {n: given.get(n, F.lit(None)).cast(kind) for n, kind in ATTRIBUTES.items()}


def ntb_emea(staged: DataFrame, customers: DataFrame, calendar: DataFrame, release: Column, whole: dict[str, Column] | None = None) -> DataFrame:
    """Text ASAP becomes the release day + 73, or + 103 where the material's lead time (``production_lt``, of the
    material that ``resolve_product`` found) is 110; other texts give the Monday of their week within eleven months of the
    release, and rows without one drop out, before the others meet the customers."""
    asap = F.upper("delivery_text") == "ASAP"
    first, last = date_id(release), date_id(add_months(release, 11))
    mondays = calendar.filter((F.col("day_name_of_week") == "Monday") & F.col("id").between(first, last)).groupBy("week_accounting").agg(F.min("id").alias("_monday"))
    names = dedup_lookup(customers.select("name", F.col("id").alias("dim_customer_id")), ["name"], "dim_customer_id")
    j = (staged.filter(F.col("quantity").isNotNull()).withColumn("week_accounting", week_from_text("delivery_text"))
               .join(F.broadcast(mondays), "week_accounting", "left").filter(asap | F.col("_monday").isNotNull())
               .join(names, F.col("customer_text") == F.col("name")))
    days = F.when(F.col("production_lt") == LONG_LEAD_TIME, ASAP_DAYS_LONG).otherwise(ASAP_DAYS)
    date = F.when(asap, date_id(add_days(release, days))).otherwise(F.col("_monday"))
    return _facts(j, F.coalesce("pr_code", F.lit(UNDEFINED)), date, F.coalesce(asap, F.lit(False)).cast("int"), whole)


def ntb_apac(staged: DataFrame, customers: DataFrame, whole: dict[str, Column] | None = None) -> DataFrame:
    """The order number is the request and its line; customers by name, rows of unknown ones drop out."""
    names = dedup_lookup(customers.select("name", F.col("id").alias("dim_customer_id")), ["name"], "dim_customer_id")
    j = staged.filter(F.col("quantity").isNotNull()).join(names, F.col("customer_text") == F.col("name"))
    order = F.concat_ws("-", F.coalesce("pr_code", F.lit(UNDEFINED)), F.coalesce("item", F.lit(UNDEFINED)))
    return _facts(j, order, date_id("requested"), F.lit(0), whole)


def ntb_by_resolution(staged: DataFrame, lookups: list, placeholder: int, whole: dict[str, Column] | None = None, by_line: bool = True) -> DataFrame:
    """The order number is the request, ``by_line`` with its line (NORA); customers through an ordered list of lookups (name, DC code, mapped child), else the region's placeholder;
    delivery dates that are no dates drop out; quantities are multiplied by the pack size in the size text ('P6': 6)."""
    dated = staged.filter(F.col("quantity").isNotNull()).withColumn("_d", safe_date("delivery_text")).filter(F.col("_d").isNotNull())
    j = resolve(dated, lookups, "dim_customer_id", placeholder=placeholder)
    pack = F.coalesce(F.regexp_extract(F.coalesce("size", F.lit("")), r"^P(\d+)$", 1).try_cast("int"), F.lit(1))
    j = j.withColumn("quantity", F.col("quantity") * pack)
    request = F.coalesce("pr_code", F.lit(UNDEFINED))
    order = F.concat_ws("-", request, F.coalesce("item", F.lit(UNDEFINED))) if by_line else request
    return _facts(j, order, date_id("_d"), F.lit(0), whole)


def forecast(staged: DataFrame, calendar: DataFrame, season_col: str, materials: DataFrame, customers: DataFrame) -> DataFrame:
    """(season, month) to the first day of that month of the season (``season_col`` of the calendar), material and
    region to their placeholders, summed.  Unknown seasons, materials or regions drop out."""
    first = calendar.groupBy(F.col(season_col).alias("season"), F.col("month_name_short_accounting").alias("month")).agg(F.min("id").alias("dim_date_id"))
    j = (staged.join(F.broadcast(first), ["season", "month"]).join(dedup_lookup(materials, ["material_id"], "id").withColumnRenamed("id", "dim_product_id"), "material_id")
               .join(dedup_lookup(customers, ["region"], "id").withColumnRenamed("id", "dim_customer_id"), "region"))
    return j.groupBy("dim_date_id", "dim_product_id", "dim_customer_id").agg(F.sum("quantity").alias("quantity"))


def order_delta(header: DataFrame, line: DataFrame, shipped: DataFrame, run_date: Column) -> DataFrame:
    """Order headers left-joined to lines and shipped quantities, where the revised date lies in the month
    before the run date or later.  ``header``: (order_id, customer, status, revised); ``line``: (order_id, line_id, material,
    ordered); ``shipped``: (order_id, line_id, shipped)."""
    h = header.filter(F.col("revised") >= add_months(run_date, -1))
    s = shipped.groupBy("order_id", "line_id").agg(F.sum("shipped").alias("shipped"))
    return h.join(line, "order_id", "left").join(s, ["order_id", "line_id"], "left")


def load_orders(fact: DataFrame, delta: DataFrame) -> DataFrame:
    """Facts from the delta's first date on are replaced by the delta's lines, summed per key; a shipped order counts
    its shipped quantity, an open one what was ordered.  ``fact`` and the result: (order_id, material, customer, category,
    dim_date_id, quantity)."""
    shipped = F.col("status") == "Shipped"
    new = delta.filter(F.col("line_id").isNotNull()).withColumn("_q", F.when(shipped, F.coalesce("shipped", F.lit(0))).otherwise(F.col("ordered")))
    new = new.groupBy("order_id", "material", "customer", F.when(shipped, "Shipped Order").otherwise("Open Order").alias("category"),
                      date_id("revised").alias("dim_date_id")).agg(F.sum("_q").alias("quantity"))
    first = F.broadcast(delta.agg(F.min(date_id("revised")).alias("_first")))  # one row
    kept = fact.join(first, F.coalesce(F.col("dim_date_id") >= F.col("_first"), F.lit(False)), "left_anti")
    return kept.unionByName(new.select(*fact.columns))
