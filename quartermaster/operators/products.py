"""Product dimension maintenance (D10-D16): inserts, updates and the chain of placeholders.

Every lookup is reduced to one row per key first, so a repeated source row never multiplies products."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import dash_flag, gender_new, product_type, style_id_erp, style_name_new
from .lookups import dedup_lookup, mapped_dimension, resolve
from .merge import update_from

FLAGS = ["qt_mtl", "clk_mtl", "sjd_mtl", "dtp_mtl"]
ATTRIBUTES = ["style_id", "color", "style_name", "gender", "lifecycle", "style_complexity", "construction_type"]
#: Levels of placeholders above the material, in the order they are added.
LEVELS = ["style_id", "style_complexity", "construction_type", "gender"]


def _as_dim(df: DataFrame, dim: DataFrame) -> DataFrame:
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None).cast(dim.schema[c].dataType)).alias(c) for c in dim.columns])


def new_from_priority(dim: DataFrame, priority: DataFrame) -> DataFrame:
    """One placeholder row at material level for each material of the priority list that the dimension lacks."""
    rows = priority.join(dim.select("material_id").distinct(), "material_id", "left_anti")
    rows = rows.groupBy("material_id").agg(*[F.max(c).alias(c) for c in priority.columns if c != "material_id"])
    rows = rows.withColumns({f: dash_flag(f) for f in FLAGS}).withColumns({
        "size": F.col("material_id"), "style_id": F.col("material_id"), "is_placeholder": F.lit(1), "placeholder_level": F.lit("material_id")})
    return _as_dim(rows, dim)


def new_from_orders(dim: DataFrame, orders: DataFrame) -> DataFrame:
    """A product for each (material without blanks, trimmed size) of the ERP orders that the dimension lacks."""
    rows = orders.groupBy(F.replace(F.col("material_id"), F.lit(" "), F.lit("")).alias("material_id"),
                          F.trim(F.coalesce("size", F.lit(""))).alias("size")).agg(F.max("color").alias("color"))
    rows = rows.join(dim.select("material_id", "size").distinct(), ["material_id", "size"], "left_anti")
    return _as_dim(rows.withColumns({"style_id": F.col("material_id"), "lifecycle": F.lit("Active"), "style_complexity": F.lit("N/A"),
                                     "is_placeholder": F.lit(0)}), dim)


def new_sizes(dim: DataFrame, sources: list[DataFrame], width: int = 11) -> DataFrame:
    """Sizes of the need-to-buy sources that the dimension lacks, with the attributes (MAX) of their material; the
    material id is cut to ``width`` characters as the load specifies.  Unknown materials add nothing."""
    all_ = reduce(lambda a, b: a.unionByName(b), [s.select(F.substring("material_id", 1, width).alias("material_id"), "size") for s in sources]).distinct()
    rows = all_.join(dim.select("material_id", "size").distinct(), ["material_id", "size"], "left_anti")
    per = dim.groupBy("material_id").agg(*[F.max(c).alias(c) for c in [*ATTRIBUTES, *FLAGS]])
    return _as_dim(rows.join(per, "material_id").withColumn("is_placeholder", F.lit(0)), dim)


def update_from_priority(dim: DataFrame, priority: DataFrame, types: DataFrame, mapping: DataFrame) -> DataFrame:
    """Attributes from the priority list (MAX per material), its construction type resolved directly or through the
    mapping; rows whose type resolves to nothing update nothing."""
    kinds = types.select(F.col("name").alias("construction_type"), "name").distinct()
    kinds_map = dedup_lookup(mapped_dimension(kinds, mapping, "Construction Type Master", "name", "construction_type"), ["child"], "mapped_id")
    p = resolve(priority.withColumnRenamed("construction_type", "_name"),
                [(kinds, [("_name", "name")], "construction_type"), (kinds_map, [("_name", "child")], "mapped_id")],
                "construction_type", drop_unresolved=True)
    p = p.withColumns({f: dash_flag(f) for f in FLAGS}).withColumn("product_type", product_type("cat_sub_sbu"))
    cols = ["lifecycle", "construction_type", "style_complexity", "color", "style_name", "product_type", *FLAGS]
    return update_from(dim, p.select("material_id", *cols), ["material_id"], cols)


def update_erp_texts(dim: DataFrame, source: DataFrame, cols: list[str], width: int = 11) -> DataFrame:
    """ERP texts by (material cut to ``width``, size)."""
    s = source.withColumn("material_id", F.substring("material_id", 1, width))
    return update_from(dim, s.select("material_id", "size", *cols), ["material_id", "size"], cols)


def placeholders(dim: DataFrame, level: str) -> DataFrame:
    """A placeholder row for each value of ``level`` that real products have and no placeholder of that level stands
    for.  At material level the attributes are kept (MAX); above it, only the level's own value.  NULL and 'PLACEHOLDER'
    values have none."""
    own = dim.filter((F.col("is_placeholder") == 0) & F.col(level).isNotNull() & (F.col(level) != "PLACEHOLDER"))
    done = dim.filter((F.col("is_placeholder") == 1) & (F.col("placeholder_level") == level)).select(
        F.col("material_id").alias(level)).distinct()
    rows = own.join(done, level, "left_anti").groupBy(level).agg(*([F.max(c).alias(c) for c in ATTRIBUTES] if level == "material_id" else [F.lit(1).alias("_")]))
    if level != "material_id":
        rows = rows.withColumn("material_id", F.col(level))
    return _as_dim(rows.withColumns({"size": F.col("material_id"), "is_placeholder": F.lit(1), "placeholder_level": F.lit(level)}), dim)


def placeholder_chain(dim: DataFrame) -> DataFrame:
    """The dimension with the placeholders of every level."""
    return reduce(lambda d, level: d.unionByName(placeholders(dim, level)), ["material_id", *LEVELS], dim)


def derived_texts(dim: DataFrame) -> DataFrame:
    """The derived text columns."""
    return dim.withColumns({"gender_new": gender_new("style_name"), "style_name_new": style_name_new("style_name"), "style_id_erp": style_id_erp("material_id")})
