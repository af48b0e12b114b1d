"""Adjustments of loaded demand (L05, L14, L40-L45, L50-L52): netting, cutoff days, minimum quantities, overrides.

Group totals are aggregates joined back (partial aggregation runs map-side, AQE splits hot join keys); small rule tables
are left to AQE, which broadcasts them from their measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookups import dedup_lookup
from .merge import update_from

# fixed values: primary factories whose materials count as single-sourced.
SINGLE_SOURCE_FACTORIES = ["CLK", "DTP", "SJD", "MTL"]


def source_label(second_factory: Column, style_complexity: Column, first_short_name: Column) -> Column:
    """Dual source with a secondary factory, a flex style, or a primary factory outside the fixed list."""
    return (F.when(F.coalesce(second_factory, F.lit(0)) != 0, "Dual source")
            .when(style_complexity.ilike("%flex%"), "Dual source")
            .when(~first_short_name.isin(SINGLE_SOURCE_FACTORIES), "Dual source").otherwise("Single source"))


def lead_time(demand_date: Column, release_date: Column) -> Column:
    """Days from the release to the demand date."""
    return F.datediff(demand_date, release_date)


def net_demand(ntb: DataFrame, orders: DataFrame, key: list[str]) -> DataFrame:
    """Need-to-buy rows lose the summed order quantity of their key, not below 0; ``consumed_quantity`` is the
    absolute difference.  Rows without orders (and with a NULL in the key, as ``=`` never matches it) stay as they are."""
    per = orders.groupBy(*key).agg(F.sum("quantity").alias("_ordered"))
    left = F.col("quantity_unconsumed") - F.col("_ordered")
    hit = F.col("_ordered").isNotNull()
    return (ntb.join(per, key, "left")
               .withColumn("quantity", F.when(hit, F.greatest(left, F.lit(0))).otherwise(F.col("quantity")))
               .withColumn("consumed_quantity", F.when(hit, F.abs(left)).otherwise(F.col("consumed_quantity")))
               .drop("_ordered"))


def cutoff_adjust(fact: DataFrame, factory_cutoff: DataFrame, calendar: DataFrame, dc: str = "EU DC",
                  crossdock: str = "EU Crossdock") -> DataFrame:
    """For the two sold-to types, move the date to the cutoff weekday of the factory's port in the same week; dates
    without a cutoff day stay.  ``factory_cutoff``: (dim_factory_id, cutoff_day_dc, cutoff_day_crossdock)."""
    week = calendar.select(F.col("id").alias("dim_date_id"), "year_cw_accounting")
    target = calendar.select("year_cw_accounting", F.col("day_name_of_week").alias("_day"), F.col("id").alias("_target"))
    day = F.when(F.col("sold_to_party") == dc, F.col("cutoff_day_dc")).when(F.col("sold_to_party") == crossdock, F.col("cutoff_day_crossdock"))
    j = (fact.join(F.broadcast(week), "dim_date_id", "left").join(factory_cutoff, "dim_factory_id", "left")
             .withColumn("_day", day).join(F.broadcast(target), ["year_cw_accounting", "_day"], "left"))
    return j.withColumn("dim_date_id", F.coalesce("_target", "dim_date_id")).select(*fact.columns)


def moq(fact: DataFrame, policy: DataFrame) -> DataFrame:
    """Material totals by region and by customer, thresholds, flags and the upcharge.

    ``fact`` has program, category, dim_date_id, dim_factory_id, vendor_group, region, dim_customer_id, material_id,
    product_type, quantity; ``policy``: (product_type, from_by_region, from_by_customer, upcharge).  Kept as specified:
    the upcharge's second policy lookup goes by the region threshold alone, whatever the product type.
    """
    region_key = ["program", "category", "dim_factory_id", "region", "material_id"]
    customer_key = ["program", "category", "dim_date_id", "vendor_group", "dim_customer_id", "material_id"]
    by_region = fact.groupBy(*region_key).agg(F.sum("quantity").alias("quantity_region"))
    by_customer = fact.groupBy(*customer_key).agg(F.sum("quantity").alias("quantity_customer"))
    limits = policy.groupBy("product_type").agg(F.max("from_by_region").alias("region_moq"))
    top = policy.join(limits, "product_type").groupBy("product_type").agg(
        F.max(F.when(F.col("from_by_region") != F.col("region_moq"), F.col("from_by_customer"))).alias("_moq_below"),
        F.max(F.when(F.col("from_by_region") == F.col("region_moq"), F.col("from_by_customer"))).alias("_moq_reached"))
    charge = dedup_lookup(policy, ["from_by_region"], "upcharge")
    charge = dedup_lookup(policy.drop("upcharge").join(charge, "from_by_region"), ["product_type", "from_by_customer"], "upcharge")
    charge = charge.withColumnsRenamed({"from_by_customer": "customer_moq", "upcharge": "_charge"})
    out = (fact.join(by_region, region_key, "left").join(by_customer, customer_key, "left")
               .join(limits, "product_type", "left").join(top, "product_type", "left"))
    out = out.withColumn("region_below_moq", F.when(F.col("region_moq").isNotNull(), (F.coalesce(
        F.col("quantity_region") < F.col("region_moq"), F.lit(False))).cast("int")))
    out = out.withColumn("customer_moq", F.when(F.col("region_below_moq") == 1, F.col("_moq_below")).otherwise(F.col("_moq_reached")))
    out = out.withColumn("customer_below_moq", F.coalesce(F.col("quantity_customer") < F.col("customer_moq"), F.lit(False)).cast("int"))
    out = out.join(charge, ["product_type", "customer_moq"], "left")
    found = F.col("_charge").isNotNull() | F.col("customer_moq").isNotNull()
    out = out.withColumn("upcharge", F.when(found, F.when(F.col("customer_below_moq") == 1, F.col("_charge")).otherwise(0.0)))
    return out.drop("_moq_below", "_moq_reached", "_charge")


def override_region(fact: DataFrame, report: DataFrame, key: list[str]) -> DataFrame:
    """Columns of the region report replace the fact's; order numbers missing in it become 'UNDEFINED', its Y flag
    becomes 1 and anything else 0.  A key that occurs several times in the report counts once (MAX per column)."""
    cols = [c for c in report.columns if c not in key]
    r = report
    for c in ("order_number", "order_number_original"):
        if c in cols:
            r = r.withColumn(c, F.coalesce(c, F.lit("UNDEFINED")))
    if "region_below_moq" in cols:
        r = r.withColumn("region_below_moq", F.when(F.col("region_below_moq") == "Y", 1).otherwise(0))
    return update_from(fact, r, key, cols)


def override_vendor(fact: DataFrame, report: DataFrame, key: list[str], factory: DataFrame, calendar: DataFrame,
                    performance: DataFrame, placeholder: int) -> DataFrame:
    """The vendor report sets lead time (confirmed date less buy date), delay in days (confirmed less requested), its
    performance class, the date (requested) and the final factory by short name, or the placeholder.  Rows whose
    requested date is not in the calendar change nothing."""
    known = F.broadcast(calendar.select(F.col("full_date").alias("requested_crd"), F.col("id").alias("dim_date_id")))
    names = dedup_lookup(factory.select(F.col("short_name").alias("final_factory"), "dim_factory_id"), ["final_factory"], "dim_factory_id")
    r = (report.join(known, "requested_crd").join(names, "final_factory", "left")
               .withColumn("dim_factory_id_final", F.coalesce("dim_factory_id", F.lit(placeholder)))
               .withColumn("status_orig_req", F.datediff("confirmed_crd", "requested_crd"))
               .join(performance.withColumnRenamed("days_delay", "status_orig_req"), "status_orig_req", "left"))
    cols = ["confirmed_crd", "status_orig_req", "delivery_performance", "dim_date_id", "dim_factory_id_final", "comment_vendor"]
    base = fact.withColumns({c: F.lit(None).cast(r.schema[c].dataType) for c in cols if c not in fact.columns})
    out = update_from(base, r.select(*key, *cols), key, cols)
    return out.withColumn("production_lt_actual_vendor", F.datediff("confirmed_crd", "buy_date"))


def override_allocation(fact: DataFrame, report: DataFrame, key: list[str], factory: DataFrame, edited: Column) -> DataFrame:
    """The allocation team's factory (known short names only), comment, component factory and edit time."""
    names = dedup_lookup(factory.select(F.col("short_name").alias("factory_code"), "dim_factory_id"), ["factory_code"], "dim_factory_id")
    r = report.join(names, "factory_code").withColumn("edit_dt", edited)
    cols = ["dim_factory_id", "comment_vfa", "component_factory_short_name", "edit_dt"]
    base = fact.withColumns({c: F.lit(None).cast(r.schema[c].dataType) for c in cols if c not in fact.columns})
    return update_from(base, r.select(*key, *cols), key, cols)
