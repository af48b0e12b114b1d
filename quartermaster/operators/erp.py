"""Order extract from the ERP tables (S08, L20): six tables with one-to-many keys, code lists as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import add_months

# fixed values: order types that belong to the business, and stores and sources that do not.  The product groups of a
# business carry its name, so the caller brings them.
ORDER_TYPES = ["DS", "DYO", "PG", "REGULAR", "ZCS", "ZCUS", "ZDIR", "ZFGP", "ZOT", "ZRDS", "ZTP", "ZVFL", "ZVFS", "Z002", "Z003", "Z004"]
OTHER_SOURCES = ["DIRECT BRAZIL"]
CANCELED = "CANCELED"
OTHER_STORES = (
    "DP0NS DP1D DPBO DPBS DPCH1 DPDEN DPFIN DPK3 DPN7 DPN8 DPNNS DPNO1 DPNS DPNU3 DPR1D DPSEV DPSWE DPSWV DPTB DPTD DPTE DPTF1 DPTF2 DPTI "
    "DPTK DPTS DPTU1 DPTU2 DPTU3 DPTU4 DPTZ DPU3 DPVA1 DPVB2 DPVB3 DPVC0 DPVC1 DPVC2 DPVE1 DPVE2 DPVE3 DPVE4 DPVE5 DPVE6 DPVF1 DPVF2 DPVF3 "
    "DPVF4 DPVF5 DPVG1 DPVG2 DPVG3 DPVG4 DPVG5 DPVG6 DPVG7 DPVI0 DPVI1 DPVI2 DPVI3 DPVI4 DPVI5 DPVI6 DPVI7 DPVI8 DPVI9 DPVN1 DPVS0 DPVU1 "
    "DPVU2 DPVU3 DPVU4 DPVU5 DPVU6 DPVU7 DPXX VE1D VEHP VX1D VX1W VX22 VX4S VXU3 DPVCD DPEJP DPEJ7 DPEST DPDZ DPR1 DP1P DPAW DPF1 DPF2 "
    "DPU1 DPF3 DPN1 DPH6").split()

SHIPPED_KEY = ["season", "style", "lot", "color", "size", "dimension"]
#: Output column -> column of the joined tables whose blanks are trimmed.
TRIMMED = {
    "dim_factory_vendor_code": "rdacode", "dim_factory_factory_code": "rfactory", "po_code_cut": "lot", "dim_product_sbu": "misc1",
    "dim_product_size": "size", "dim_product_color_description": "color", "dimension": "dimension", "source": "misc6", "dim_product_style_id": "style",
    "po_code": "ship_no", "po_type": "misc25", "vf_sla": "misc41", "dim_customer_dc_code_brio": "store_no", "delay_reason": "misc18",
    "shipment_id": "shipment", "source_system": "misc21", "dc_name": "shipname", "sales_order": "misc27"}


def wanted_headers(header: DataFrame, run_date: Column, product_groups: list[str]) -> DataFrame:
    """Order headers of the business whose revised date lies in the month before the run date or later.  As in the source, a
    code that is missing fails its filter."""
    c = F.col
    return header.filter(
        (c("revdd") >= add_months(run_date, -1)) & ~c("misc6").isin(OTHER_SOURCES) & c("misc1").isin(product_groups)
        & ~((c("qtyship") == 0) & (c("done") == 1)) & (c("polocation") != CANCELED) & c("misc25").isin(ORDER_TYPES) & ~c("store_no").isin(OTHER_STORES))


def extract_orders(header: DataFrame, line: DataFrame, shipped: DataFrame, shipment: DataFrame, shipmast: DataFrame, scale: DataFrame,
                   run_date: Column, product_groups: list[str]) -> DataFrame:
    """One row for each order line and shipment of it, with the shipment's closing, the store's name and quantities scaled
    by the size's factor.

    The header filters act on the big tables before those are dealt out by their own keys: lines meet only the wanted
    headers, and shipped lines are first reduced to the seasons, styles and lots that those name (a semi-join that AQE
    broadcasts when the month's headers are few)."""
    head = wanted_headers(header, run_date, product_groups)
    lots = head.select("season", "style", "lot").distinct()
    sent = shipped.withColumnRenamed("cut", "lot").join(lots, ["season", "style", "lot"], "left_semi")
    lines = head.join(line.filter(F.col("qty") != 0), "id_cut")
    j = (lines.join(sent, SHIPPED_KEY, "left")
              .join(shipment.select("shipment", "closed", "firstclosedon"), "shipment", "left")
              .join(shipmast.select(F.col("shipno").alias("store_no"), "shipname"), "store_no", "left")
              .join(scale.select(F.col("scale").alias("size"), F.col("desce").try_cast("bigint").alias("factor")), "size", "left"))
    factor = F.when(F.coalesce("factor", F.lit(0)) == 0, 1).otherwise(F.col("factor"))
    return j.select(
        *[F.trim(F.col(c)).alias(n) for n, c in TRIMMED.items()], F.col("plan_date").alias("po_issue_dt"), F.col("closed").alias("shipment_status"),
        F.col("qty").alias("order_qty"), F.col("unitship").alias("shipped_qty"), "actual_crd_dt", F.col("revdd").alias("revised_crd_dt"),
        F.col("shipdate").alias("shipped_dt"), (F.col("qty") * factor).alias("lum_order_qty"), (F.col("unitship") * factor).alias("lum_shipped_qty"),
        F.col("firstclosedon").alias("shipment_closed_on_dt"), F.col("done").alias("is_po_completed"))
