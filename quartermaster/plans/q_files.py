"""Queries for file and slice sources (S01-S04, S10, S12, S13) and the remaining master tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import master, merge, validate
from ..operators.master import Found, Rules
from ..session import scratch_path
from ..sources import files
from ..sources.slices import SliceTable
from .model import Model
from .model_sql import sql
from .registry import query


def s01_files(spark, sf_dir):
    """S01 read of delimited text written from the supplier table, S02 its delimiter found from the lines, S03 the files
    that a half-recorded listing calls changed, S04 conversion to the staging types."""
    s = Model(spark, sf_dir).table("supplier")
    path = scratch_path(spark, "suppliers-csv")
    s.select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 7 == 0, "n/a").otherwise(F.col("s_nationkey").cast("string")).alias("nation"),
             F.col("s_acctbal").cast("string").alias("balance")).write.option("sep", "|").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    sep = files.detect_delimiter(spark.read.text(path)).first()["delimiter"]
    text = T.StructType([T.StructField(n, T.StringType()) for n in ("s_suppkey", "s_name", "nation", "balance")])
    raw = files.read_csv(spark, path, sep, text)
    staged = files.conform(raw, T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("nation", T.IntegerType()),
                                              T.StructField("balance", T.DoubleType())]))
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path", "modificationTime")
    stale = files.changed_sources(listing, listing.limit(0)).join(files.changed_sources(listing, listing), "path", "left_anti")
    all_new = stale.agg((F.count(F.lit(1)) == F.lit(listing.count())).alias("all_new"))
    return staged.join(F.broadcast(all_new)).withColumn("delimiter", F.lit(sep))


query("s01_files", sql("""
SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 7 <> 0 THEN s_nationkey END AS nation, s_acctbal AS balance, TRUE AS all_new, '|' AS delimiter
FROM supplier"""))(s01_files)


def s10_replace_slice(spark, sf_dir):
    """S10 one release's slice replaced in a partitioned table, the other slices kept; S12 transfer from a first date; S13
    conditional delete."""
    m = Model(spark, sf_dir)
    d = m.demand.select("demand_category", F.date_format("demand_date", "yyyyMMdd").alias("day"), "quantity", F.year("release_date").alias("release_year"))
    keys = ["release_year", "demand_category"]
    table = SliceTable(spark, scratch_path(spark, "demand-slices"), keys)
    per = d.groupBy("demand_category", "release_year", "day").agg(F.sum("quantity").alias("quantity"))
    table.replace(per, [r.asDict() for r in per.select(*keys).distinct().collect()])
    new = per.filter((F.col("release_year") == 1997) & (F.col("demand_category") == "Forecast")).withColumn("quantity", F.lit(0).cast("bigint"))
    table.replace(new, [{"release_year": 1997, "demand_category": "Forecast"}])
    out = files.transfer(table.read(), ["day"], "day", F.lit("1996-06-01").cast("date"))
    out = files.delete_where(out, F.dayofweek("day") == 1, F.month("day") == 2)
    return out.groupBy("release_year", "demand_category").agg(F.count(F.lit(1)).alias("n_days"), F.sum("quantity").alias("quantity"))


query("s10_replace_slice", sql("""
SELECT CAST(year(release_date) AS INTEGER) AS release_year, demand_category, count(DISTINCT demand_date) AS n_days,
       CAST(sum(CASE WHEN year(release_date) = 1997 AND demand_category = 'Forecast' THEN 0 ELSE quantity END) AS BIGINT) AS quantity
FROM demand WHERE demand_date >= DATE '1996-06-01' AND dayofweek(demand_date) <> 0 AND month(demand_date) <> 2 GROUP BY 1, 2""", "demand"))(s10_replace_slice)


def s10_slice_commits(spark, sf_dir):
    """S10 loads of named slices: one replaced, one cleared by an empty load, the others kept."""
    m = Model(spark, sf_dir)
    o = m.table("orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("priority"))
    table = SliceTable(spark, scratch_path(spark, "order-slices"), ["year", "priority"])
    table.replace(o, [r.asDict() for r in o.select("year", "priority").distinct().collect()])  # the caller's list of slices
    table.replace(o.filter("year = 1998 AND priority = '1-URGENT'").withColumn("o_totalprice", F.lit(1.0)), [{"year": 1998, "priority": "1-URGENT"}])
    table.replace(o.limit(0), [{"year": 1997, "priority": "5-LOW"}, {"year": 2050, "priority": "5-LOW"}])
    return table.read().groupBy("year", "priority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


query("s10_slice_commits", sql("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS priority, count(*) AS n,
       round(sum(CASE WHEN year(o_orderdate) = 1998 AND o_orderpriority = '1-URGENT' THEN 1.0e0 ELSE o_totalprice END), 2) AS total
FROM orders WHERE NOT (year(o_orderdate) = 1997 AND o_orderpriority = '5-LOW') GROUP BY 1, 2"""))(s10_slice_commits)


SOURCE_SEPARATORS = {"acme.csv": "|", "bolt.csv": ";", "cord.csv": "\t"}


def s03_load_if_newer(spark, sf_dir):
    """S01-S04 three delimited sources with their own separators, Latin-1 letters and rows with too many fields, loaded by
    the manifest; one changes and the second run loads it alone."""
    s = Model(spark, sf_dir).table("supplier")
    folder = scratch_path(spark, "sources")
    staging = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("nation", T.IntegerType()), T.StructField("balance", T.DoubleType())])
    table = SliceTable(spark, scratch_path(spark, "staged"), ["source"])

    def write(name, i, scale):
        sep = SOURCE_SEPARATORS[name]
        k = F.col("s_suppkey")
        fields = [k.cast("string"), F.concat(F.lit("Caf\u00e9 "), "s_name"), F.when(k % 7 == 0, "n/a").otherwise(F.col("s_nationkey").cast("string")),
                  (F.col("s_acctbal") * scale).cast("decimal(18,2)").cast("string")]
        line = F.concat_ws(sep, *fields, F.when(k % 11 == 0, F.lit("more")))
        head = spark.createDataFrame([(-1, sep.join(staging.names))], "k long, value string")
        rows = head.union(s.filter(k % 3 == i).select(k.alias("k"), line.alias("value"))).coalesce(1).sortWithinPartitions("k")
        rows.select("value").write.mode("overwrite").option("encoding", "ISO-8859-1").csv(
            f"{folder}/{name}", sep="\u0001", quote="", escapeQuotes=False, quoteAll=False)

    for i, name in enumerate(SOURCE_SEPARATORS):
        write(name, i, 1)
    first = files.load_changed(spark, folder, table, staging)
    write("bolt.csv", 1, 2)
    second = files.load_changed(spark, folder, table, staging)
    third = files.load_changed(spark, folder, table, staging)
    runs = F.create_map(*[x for n in SOURCE_SEPARATORS for x in (F.lit(n), F.lit((n in first) + (n in second) + (n in third)))])
    return table.read().select("source", "id", "name", "nation", "balance", runs[F.col("source")].alias("loads"))


query("s03_load_if_newer", sql("""
SELECT (['acme.csv', 'bolt.csv', 'cord.csv'])[s_suppkey % 3 + 1] AS source, s_suppkey AS id, 'Café ' || s_name AS name,
       CASE WHEN s_suppkey % 7 <> 0 THEN s_nationkey END AS nation, CAST(CAST(s_acctbal * CASE WHEN s_suppkey % 3 = 1 THEN 2 ELSE 1 END AS DECIMAL(18,2)) AS DOUBLE) AS balance,
       CASE WHEN s_suppkey % 3 = 1 THEN 2 ELSE 1 END AS loads
FROM supplier WHERE s_suppkey % 11 <> 0"""))(s03_load_if_newer)


def v33_capacity_grid(spark, sf_dir):
    """V33 submitted weekly capacity: type, factory and year are checked, then the cells are inserted or updated; V13 the
    suites that a category calls for."""
    m = Model(spark, sf_dir)
    k = F.col("dim_factory_id")
    cap = m.capacity.join(m.factory.select("dim_factory_id", "short_name"), "dim_factory_id").withColumn("year", F.floor(F.col("week_date_id") / 10000).cast("int"))
    cells = cap.select(F.col("short_name").alias("factory"), "construction_type", "year", "week_date_id", F.col("capacity_available_weekly").alias("cells"))
    rules = Rules(["factory", "construction_type", "week_date_id"], ["construction_type", "factory", "year"],
                  [Found(["construction_type"], m.product.select("construction_type")), Found(["factory"], m.factory.select("short_name"))],
                  [~F.col("year").between(1990, 2050)])
    sent = cells.filter(F.col("week_date_id") % 3 != 0).withColumn("cells", F.col("cells") + 1)
    current = cap.filter(k % 2 == 0).select(F.col("short_name").alias("factory"), "construction_type", "year", "week_date_id", F.col("capacity_available_weekly").alias("cells"))
    ok = master.verdict(sent, rules, duplicates_allowed=True)
    new = merge.upsert(current, sent, ["factory", "construction_type", "week_date_id"])
    suites = {"21": [validate.not_in_list(new, "construction_type", ["STANDARD", "PROMO"], "Capacity", "Construction type invalid")],
              "22": [validate.missing_in(new, ["factory"], m.factory.filter(k % 10 != 0), ["short_name"], "Capacity", "Factory missing")]}
    found = validate.run_suite(validate.dispatch(["21", "22", "99"], suites), system="DEMAND")
    a = new.agg(F.count(F.lit(1)).alias("n"), F.sum("cells").alias("value")).select(F.lit("cells").alias("item"), "n", "value")
    b = ok.select(F.concat(F.lit("verdict "), "outcome").alias("item"), F.col("n_rows").alias("n"), F.col("n_keys").alias("value"))
    c = found.groupBy("category").agg(F.count(F.lit(1)).alias("n")).select(F.col("category").alias("item"), "n", F.lit(None).cast("bigint").alias("value"))
    return a.unionByName(b).unionByName(c)


query("v33_capacity_grid", sql("""
SELECT 'cells' AS item, count(*) AS n, CAST(sum(capacity_available_weekly + CASE WHEN week_date_id % 3 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS value
FROM capacity WHERE week_date_id % 3 <> 0 OR dim_factory_id % 2 = 0
UNION ALL SELECT 'verdict ok', count(*), count(DISTINCT (short_name, construction_type, week_date_id)) FROM capacity JOIN factory USING (dim_factory_id) WHERE week_date_id % 3 <> 0
UNION ALL SELECT 'Construction type invalid', count(DISTINCT construction_type), NULL FROM capacity
  WHERE (week_date_id % 3 <> 0 OR dim_factory_id % 2 = 0) AND construction_type NOT IN ('STANDARD', 'PROMO')
UNION ALL SELECT 'Factory missing', count(DISTINCT short_name), NULL FROM capacity JOIN factory USING (dim_factory_id)
  WHERE (week_date_id % 3 <> 0 OR dim_factory_id % 2 = 0) AND dim_factory_id % 10 = 0""", "capacity", "factory"))(v33_capacity_grid)


def v34_allocation_sandbox(spark, sf_dir):
    """V34 sandbox of proposed factories: unknown factories and changes without a comment are invalid and change nothing, the
    others are applied; the snapshot holds the orders whose factory differs.  V36 sync of a table without rules."""
    m = Model(spark, sf_dir)
    k = F.col("order_id")
    base = m.table("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.min("l_suppkey").alias("dim_factory_id"))
    sent = base.filter(k % 3 == 0).select("order_id", F.when(k % 4 == 0, F.col("dim_factory_id")).otherwise((F.col("dim_factory_id") * 3) % 110).alias("proposed"),
                                          F.when(k % 5 != 0, "why").alias("comment"), F.col("dim_factory_id").alias("was"))
    rules = Rules(["order_id"], ["order_id"], [Found(["proposed"], m.factory.select("dim_factory_id"), True)],
                  [(F.col("proposed") != F.col("was")) & (F.trim(F.coalesce("comment", F.lit(""))) == "")])
    good = master.marked(sent, rules).filter(~F.col("_bad")).select("order_id", "proposed")
    moved = base.join(good, "order_id").filter(F.col("proposed") != F.col("dim_factory_id"))
    current = base.select((k % 50).alias("table_name"), F.lit("old").alias("state")).distinct()
    synced, _ = master.sync(current, m.table("nation").select(F.col("n_nationkey").cast("bigint").alias("table_name"), F.lit("new").alias("state")), Rules(["table_name"], ["table_name"]))
    return (moved.groupBy(F.lit("moved").alias("kind"), F.col("proposed").alias("key")).agg(F.count(F.lit(1)).alias("n"))
                 .unionByName(synced.groupBy(F.concat_ws(" ", F.lit("sync"), "action", "state").alias("kind"), F.lit(None).cast("bigint").alias("key")).agg(F.count(F.lit(1)).alias("n"))))


query("v34_allocation_sandbox", sql("""
SELECT 'moved' AS kind, f * 3 % 110 AS key, count(*) AS n FROM (SELECT l_orderkey AS k, min(l_suppkey) AS f FROM lineitem GROUP BY 1) b
WHERE k % 3 = 0 AND k % 4 <> 0 AND f * 3 % 110 <> f AND k % 5 <> 0 AND f * 3 % 110 IN (SELECT s_suppkey FROM supplier) GROUP BY 2
UNION ALL SELECT 'sync update new', NULL, count(*) FROM nation WHERE n_nationkey IN (SELECT l_orderkey % 50 FROM lineitem) HAVING count(*) > 0
UNION ALL SELECT 'sync insert new', NULL, count(*) FROM nation WHERE n_nationkey NOT IN (SELECT l_orderkey % 50 FROM lineitem) HAVING count(*) > 0"""))(v34_allocation_sandbox)
