"""Binding of the driver's TPC-H-like tables to the demand-planning entities.

Every entity here is a lazy DataFrame derived from the parquet tables, so the work of each query grows
with the data.  ``model_sql.py`` states the same definitions in SQL for the DuckDB twin; the two must
stay in step.

Binding (see SURVEY 7.2):
  demand fact  lineitem x orders; product l_partkey, original factory l_suppkey, customer o_custkey,
               date l_shipdate, release = month of o_orderdate, quantity = l_quantity as bigint
  category     o_orderstatus O/P/F -> Forecast / Need to Buy / Order
  program      first character of o_orderpriority -> one of five buying programs
  product      part; construction type p_type, complexity from p_size, flags from p_partkey residues
  factory      supplier; the first eight keys carry the eight rule-bearing short names
  customer     customer x nation x region; market region, sold-to category and party
  priority     per part: smallest and largest supplying factory
  capacity     per (factory, week, construction type) met in demand, an integer function of the keys
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookups import scalar
from ..functions.dates import date_id, week_start
from ..functions.text import pad_key

# ---- fixed values of the binding (our own test binding, not reference data) ----------------------
# Short names of the eight factories that the allocation rules name, given to supplier keys 0..7.
FACTORY_CODES = ["CLK", "DTC", "DTP", "FSC", "HSC", "ICC", "SJD", "SJV"]
# Country codes of supplier nations; every other nation is 'N<key>'.
CHINA_NATIONS = [2, 7, 12]
VIETNAM_NATIONS = [17, 22]
# Sold-to parties by (market region, c_custkey % 8) -- chosen so every party pattern of the routing
# tree occurs, together with parties that match no leaf.
SOLD_TO_PARTIES = {
    "NORA": ["US DC", "CAN DC Toronto", "US Direct ZUMIEZ", "Canada Direct", "US KOHLS Direct",
             "International", "US JOURNEYS", "Mex DC Monterrey"],
    "CASA": ["Brazil DC", "Chile DC", "MX DC Guadalajara", "Mexico Direct", "International CASA",
             "Brazil Direct", "Argentina DC", "Chile Direct"],
    "APAC": ["China DC", "Korea DC", "India DC", "Malaysia DC", "SG DC", "Hong Kong DC",
             "APAC Direct", "Korea Direct"],
    "EMEA": ["EU DC", "EU DC Duty", "UK DC", "EU Direct", "EU Crossdock", "DE DC",
             "International EMEA", "FR DC"],
}
BUYING_PROGRAMS = {
    "1": "Retail Quick Turn",
    "2": "Ad-Hoc Out of Sync",
    "3": "Bulk Buy",
    "4": "Scheduled Out of Sync",
    "5": "Ad Hoc Vendor Quick Turn",
}
DEMAND_CATEGORIES = {"O": "Forecast", "P": "Need to Buy", "F": "Order"}

# Fiscal calendar parameters: the least range; it is widened to whole years around the dates of the data.
CAL_START = "1994-01-01"
CAL_END = "2003-12-31"
CAL_FIRST_MONTH = 1
CAL_EXTRA_MONTH = 12

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


#: Years of the facts by application and version of the files.
_YEARS: dict[str, dict[int, list[int]]] = {}
#: Demand lines that a task holds at once, however many there are in all, and the fewest worth a task of their own.
TASK_LINES, LEAST_LINES = 250_000, 25_000


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(default))


@dataclass
class Model:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    # ---------------------------------------------------------------- dimensions
    @cached_property
    def product(self) -> DataFrame:
        p = self.table("part")
        name = F.col("p_name")
        cat = (F.when(name.startswith("old"), F.concat(F.lit("vault "), name))
               .when(name.startswith("new"), F.concat(F.lit("arcad "), name))
               .otherwise(name))
        return p.select(
            F.col("p_partkey").alias("dim_product_id"),
            F.concat(F.lit("VN"), pad_key("p_partkey", 8)).alias("material_id"),
            F.col("p_brand").alias("style_id"),
            name.alias("style_name"),
            F.col("p_type").alias("construction_type"),
            F.when(F.col("p_size") % 5 == 0, "Flex").otherwise("Standard").alias("style_complexity"),
            cat.alias("cat_sub_sbu"),
            (F.col("p_partkey") % 7 == 0).cast("int").alias("clk_mtl"),
            (F.col("p_partkey") % 11 == 0).cast("int").alias("dtp_mtl"),
            (F.col("p_partkey") % 13 == 0).cast("int").alias("sjd_mtl"),
            (F.col("p_partkey") % 3 == 0).cast("int").alias("qt_mtl"),
            (F.col("p_size") * 3).alias("production_lt"),
            F.col("p_retailprice").alias("fob"),
        )

    @staticmethod
    def _market(region: Column, nation: Column) -> Column:
        """Market region of a region name and a nation key."""
        return (F.when(region == "AMERICA", F.when(nation % 2 == 0, "NORA").otherwise("CASA"))
                .when(region.isin("EUROPE", "MIDDLE EAST"), "EMEA").when(region == "ASIA", "APAC").otherwise("CASA"))

    @cached_property
    def factory(self) -> DataFrame:
        n = self.table("nation").join(F.broadcast(self.table("region")), F.col("n_regionkey") == F.col("r_regionkey"))
        n = n.select("n_nationkey", self._market(F.col("r_name"), F.col("n_nationkey")).alias("factory_region"))  # 25 rows
        s = self.table("supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        key = F.col("s_suppkey")
        short = F.when(key < len(FACTORY_CODES),
                       F.element_at(F.array(*[F.lit(c) for c in FACTORY_CODES]), (key + 1).cast("int"))
                       ).otherwise(F.col("s_name"))
        nk = F.col("s_nationkey")
        country = (F.when(nk.isin(CHINA_NATIONS), "CN").when(nk.isin(VIETNAM_NATIONS), "VN")
                   .otherwise(F.concat(F.lit("N"), nk.cast("string"))))
        return s.select(
            key.alias("dim_factory_id"),
            short.alias("short_name"),
            country.alias("country_code"),
            nk.alias("allocation_group"),
            F.concat(F.lit("VG"), (key % 5).cast("string")).alias("vendor_group"),
            F.when(F.col("s_acctbal") < 0, "INACTIVE").otherwise("ACTIVE").alias("status"),
            "factory_region",
        )

    @cached_property
    def customer(self) -> DataFrame:
        c = self.table("customer")
        n = self.table("nation")
        r = self.table("region")
        region = self._market(F.col("r_name"), F.col("c_nationkey"))
        slot = (F.col("c_custkey") % 8).cast("int")
        party = None
        for reg, names in SOLD_TO_PARTIES.items():
            arr = F.array(*[F.lit(x) for x in names])
            branch = F.element_at(arr, slot + 1)
            party = F.when(F.col("_region") == reg, branch) if party is None else party.when(F.col("_region") == reg, branch)
        category = (F.when(F.col("c_mktsegment") == "FURNITURE", "Direct+International")
                    .when(F.col("c_mktsegment") == "HOUSEHOLD", "Crossdock")
                    .otherwise("DC"))
        # nation and region are tiny, fixed-size tables (25 and 5 rows): broadcasting them is safe.
        return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
                 .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
                 .withColumn("_region", region)
                 .select(F.col("c_custkey").alias("dim_customer_id"),
                         F.col("c_name").alias("customer_name"),
                         F.col("_region").alias("region"),
                         F.col("c_nationkey").alias("dim_location_id"),
                         category.alias("sold_to_category"),
                         party.alias("sold_to_party"),
                         F.col("c_mktsegment").alias("market")))

    def _years(self) -> list[int]:
        """The first and last years of the facts' dates: one pass over the two date columns for each version of the files in
        a session (the files' names stand for the version), not one for each query."""
        line, order = self.table("lineitem"), self.table("orders")
        known = _YEARS.setdefault(self.spark.sparkContext.applicationId, {})
        version = hash((tuple(sorted(line.inputFiles())), tuple(sorted(order.inputFiles()))))
        if version not in known:
            ends = scalar(line.agg(F.min("l_shipdate").cast("date").alias("a"), F.max("l_shipdate").cast("date").alias("b"))
                          .crossJoin(order.agg(F.min("o_orderdate").cast("date").alias("c"), F.max("o_orderdate").cast("date").alias("d"))))
            known[version] = [d.year for d in ends.values() if d is not None]
        return known[version]

    @cached_property
    def calendar(self) -> DataFrame:
        from ..operators.calendar import fiscal_calendar
        years = self._years()
        start = min([CAL_START, *(f"{y - 1:04d}-01-01" for y in years if f"{y:04d}-01-01" <= CAL_START)])
        end = max([CAL_END, *(f"{y + 1:04d}-12-31" for y in years if f"{y:04d}-12-31" >= CAL_END)])
        return fiscal_calendar(self.spark, start, end, CAL_FIRST_MONTH, CAL_EXTRA_MONTH)

    # ---------------------------------------------------------------- facts
    @cached_property
    def parts(self) -> int:
        """Tasks that the demand lines are dealt to: they grow with the lines (counted from the files' footers), so what one
        task sorts or groups does not.  Left alone, adaptive execution merges small shuffle blocks into tasks of tens of MB
        compressed, many times that when grouped."""
        n = self.table("lineitem").count()
        return max(1, -(-n // TASK_LINES), min(self.spark.sparkContext.defaultParallelism, n // LEAST_LINES))

    @cached_property
    def lines(self) -> DataFrame:
        """The demand columns that ``lineitem`` alone holds: no join with orders."""
        ship = F.col("l_shipdate").cast("date")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_id"), F.col("l_partkey").alias("dim_product_id"),
            F.col("l_suppkey").alias("dim_factory_id_original"), date_id(ship).alias("dim_date_id"), ship.alias("demand_date"),
            F.col("l_quantity").cast("bigint").alias("quantity"))

    @property
    def _orders(self) -> DataFrame:
        """What the demand reads of orders, as short values: they are dealt twice if they meet customers."""
        od = F.col("o_orderdate")
        return self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("_program"),
                                           F.make_date(F.year(od), F.month(od), F.lit(1)).alias("release_date"))

    @cached_property
    def demand(self) -> DataFrame:
        return self._demand(self._orders, [])

    def demand_with(self, customer: DataFrame) -> DataFrame:
        """The demand with the columns of each order's customer, which the orders are given before their lines meet them: the
        lines themselves are not dealt by customer."""
        o = self._orders.join(customer, F.col("o_custkey") == customer.dim_customer_id, "left").drop("dim_customer_id")
        return self._demand(o, [c for c in customer.columns if c != "dim_customer_id"])

    def _demand(self, o: DataFrame, more: list[str]) -> DataFrame:
        ship = F.col("l_shipdate").cast("date")
        # days and flags travel, not timestamps and texts
        li = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ship.alias("demand_date"), F.col("l_quantity").cast("bigint").alias("quantity"),
            (F.col("l_returnflag") == "R").cast("int").alias("is_edited"), "l_linestatus", "l_extendedprice")
        j = li.repartition(self.parts, "l_orderkey").join(o.repartition(self.parts, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        return j.select(
            (F.year("release_date") * 100 + F.month("release_date")).cast("int").alias("dim_release_id"),
            "release_date",
            _case(F.col("o_orderstatus"), DEMAND_CATEGORIES, "Order").alias("demand_category"),
            _case(F.col("_program"), BUYING_PROGRAMS, None).alias("buying_program"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_id"),
            F.col("l_partkey").alias("dim_product_id"),
            F.col("o_custkey").alias("dim_customer_id"),
            F.col("l_suppkey").alias("dim_factory_id_original"),
            date_id("demand_date").alias("dim_date_id"),
            "demand_date",
            "quantity",
            "is_edited",
            F.col("l_linestatus").alias("line_status"),
            F.col("l_extendedprice").alias("amount"),
            *more,
        )

    @cached_property
    def priority(self) -> DataFrame:
        """Per material: first and second priority factory (second NULL when single-sourced)."""
        li = self.table("lineitem")
        agg = li.groupBy(F.col("l_partkey").alias("dim_product_id")).agg(
            F.min("l_suppkey").alias("f1"), F.max("l_suppkey").alias("f2"))
        second = F.when((F.col("f1") == F.col("f2")) | (F.col("dim_product_id") % 4 == 0), F.lit(None)).otherwise(F.col("f2"))
        return agg.select("dim_product_id", F.col("f1").alias("dim_factory_id_1"), second.cast("bigint").alias("dim_factory_id_2"))

    @cached_property
    def capacity(self) -> DataFrame:
        """Weekly available capacity per (factory, week start, construction type) met in demand.

        A stand-in input: an integer function of the keys, with some groups left out on purpose so the
        'capacity missing' branches are exercised.  It is dealt by factory and type, so that sums by accounting week or year
        need no further shuffle.
        """
        d = self.lines.select("dim_factory_id_original", "dim_product_id", "demand_date")
        p = self.product.select("dim_product_id", "construction_type")
        keys = (d.join(p, "dim_product_id")
                 .select(F.col("dim_factory_id_original").alias("dim_factory_id"),
                         date_id(week_start(F.col("demand_date"))).alias("week_date_id"),
                         "construction_type")
                 .repartition(self.parts, "dim_factory_id", "construction_type")
                 .distinct())
        cap = ((F.col("dim_factory_id") * 37 + F.col("week_date_id") % 997 + F.length("construction_type") * 11) % 40) * 5
        return (keys.filter((F.col("dim_factory_id") + F.col("week_date_id")) % 13 != 0)
                    .select("dim_factory_id", "week_date_id", "construction_type",
                            cap.cast("bigint").alias("capacity_available_weekly")))

    # ---------------------------------------------------------------- rule helper tables
    @cached_property
    def fty_qt(self) -> DataFrame:
        """Factory quick-turn helper (material -> vendor), for quick-turn materials."""
        codes = F.array(*[F.lit(c) for c in FACTORY_CODES])
        p = self.table("part")
        return (p.filter(F.col("p_partkey") % 3 == 0)
                 .select(F.concat(F.lit("VN"), pad_key("p_partkey", 8)).alias("material_id"),
                         F.element_at(codes, (F.col("p_partkey") % len(FACTORY_CODES) + 1).cast("int")).alias("factory_short_name")))

    @cached_property
    def retail_qt(self) -> DataFrame:
        return self.retail_qt_of(self.demand)

    def retail_qt_of(self, demand: DataFrame) -> DataFrame:
        """Retail quick-turn helper (material, region, sold-to party) -> vendor: the quick-turn
        materials ordered under the retail quick-turn program in ``demand``, which may be written already."""
        codes = F.array(*[F.lit(c) for c in FACTORY_CODES])
        d = demand.filter(F.col("buying_program") == "Retail Quick Turn").select("dim_product_id", "dim_customer_id")
        c = self.customer.select("dim_customer_id", "region", "sold_to_party", "dim_location_id")
        j = d.join(c, "dim_customer_id").filter(F.col("dim_product_id") % 3 == 0)
        return (j.select(F.concat(F.lit("VN"), pad_key("dim_product_id", 8)).alias("material_id"),
                         "region", "sold_to_party",
                         F.element_at(codes, ((F.col("dim_product_id") + F.col("dim_location_id")) % len(FACTORY_CODES) + 1)
                                      .cast("int")).alias("factory_short_name"))
                  .distinct())
