"""Queries for master tables (V20-V39).  The submitted tables are stand-ins selected from the given tables by text that both
engines run; the rules themselves are written out separately in the twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import master
from ..operators.master import Found, Rules
from .model import BUYING_PROGRAMS, Model
from .model_sql import sql
from .registry import query

SHORT_PROGRAMS = {"Bulk Buy": "BB", "Retail Quick Turn": "RQT"}
PROGRAM_ROWS = [(n, SHORT_PROGRAMS.get(n, n[:4])) for n in BUYING_PROGRAMS.values()]

#: Submitted tables: selections over part (product), supplier (factory) and customer that contain some invalid rows.
SUBMITTED = {
    "retail_qt": """SELECT CASE WHEN dim_product_id % 4 = 0 THEN 'us dc' WHEN dim_product_id % 401 = 1 THEN 'Moon DC' ELSE 'EU DC' END AS sold_to_party,
        material_id AS mtl, CASE WHEN dim_product_id % 2 = 0 THEN 'clk' ELSE 'DTP' END AS factory,
        CASE WHEN dim_product_id % 3 = 0 THEN ' BB ' WHEN dim_product_id % 3 = 1 THEN 'RQT' ELSE 'Bulk Buy' END AS buying_program,
        CASE WHEN dim_product_id % 5 = 0 THEN 'dropped' WHEN dim_product_id % 499 = 2 THEN 'GONE' ELSE 'Active' END AS status FROM {product} WHERE dim_product_id % 3 = 0""",
    "fty_qt": """SELECT CASE WHEN dim_product_id % 997 = 5 THEN 'VNxx' ELSE material_id END AS mtl, CASE WHEN dim_product_id % 2 = 0 THEN 'clk' ELSE 'SJD' END AS factory FROM {product}""",
    "avg_fob": """SELECT material_id AS mtl, 'DTC' AS factory, fob FROM {product} UNION ALL SELECT material_id, 'DTC', fob FROM {product} WHERE dim_product_id % 50 = 1""",
    "cutoff": """SELECT DISTINCT country_code AS country, 'port ' || country_code AS port, CASE WHEN country_code = 'N3' THEN 'Funday' ELSE 'friday' END AS day_dc,
        'Monday' AS day_crossdock FROM {factory}""",
    "mapping": """SELECT 'Factory Master' AS type, short_name AS parent, 'old ' || short_name AS child FROM {factory} WHERE dim_factory_id % 2 = 0
        UNION ALL SELECT 'Customer Master', customer_name, CASE WHEN dim_customer_id % 90 = 7 THEN customer_name ELSE 'old ' || customer_name END FROM {customer}
        UNION ALL SELECT 'Buying Program Master', 'Bulk Buy', 'bulk' FROM {factory} WHERE dim_factory_id = 1""",
    "moq_policy": """SELECT DISTINCT CASE WHEN dim_product_id % 2 = 0 THEN 'regular' ELSE 'Vault' END AS product_type, 10 AS from_region, 20 AS from_customer FROM {product}""",
    "label_upcharge": """SELECT customer_name AS customer, CASE WHEN dim_customer_id % 2 = 0 THEN 'Shoes' ELSE 'all' END AS product_type,
        CASE WHEN dim_customer_id % 70 = 3 THEN 1.5 WHEN dim_customer_id % 9 = 1 THEN NULL ELSE 0.5 END AS upcharge FROM {customer}""",
    "capacity_by_region": """SELECT short_name AS factory, 0.25 AS emea, 0.5 AS nora, CASE WHEN dim_factory_id % 13 = 5 THEN 0.5 ELSE 0.25 END AS casa,
        CASE WHEN dim_factory_id % 2 = 0 THEN 0.0 END AS apac FROM {factory}""",
    "capacity_adjustment": """SELECT CASE WHEN dim_factory_id = 11 THEN 'nobody' ELSE lower(short_name) END AS factory, 0.8 AS percentage FROM {factory}""",
    "location": """SELECT DISTINCT region, CAST(dim_location_id AS VARCHAR(10)) AS country, CASE WHEN dim_location_id % 2 = 0 THEN 'AA' ELSE 'A' END AS code2 FROM {customer}""",
    "factory": """SELECT 'DEMAND' AS brand, country_code AS country, short_name, CASE WHEN dim_factory_id % 31 = 4 THEN 'closed' ELSE lower(status) END AS status FROM {factory}""",
    "customer": """SELECT customer_name AS name, CASE WHEN dim_customer_id % 2 = 0 THEN 'Active' ELSE 'INACTIVE' END AS status FROM {customer}
        UNION ALL SELECT customer_name, 'Active' FROM {customer} WHERE dim_customer_id % 3 = 0""",
    "empty": """SELECT material_id AS mtl, 'CLK' AS factory FROM {product} WHERE dim_product_id < 0""",
}
#: Tables whose repeated keys are reduced instead of rejected (V20); the others reject them.
SYNCED = ("location", "factory", "customer")


#: The submitted tables of V28 and V37-V39 with the business and the country; the product's lead time stands in for its size.
SUBMITTED_MORE = {
    "prebuild": """SELECT CASE WHEN dim_product_id % 83 = 6 THEN 'MOON' ELSE 'emea' END AS region, material_id AS mtl,
        CAST(CASE WHEN dim_product_id % 89 = 7 THEN production_lt + 1 ELSE production_lt END AS VARCHAR(10)) AS size,
        CASE WHEN dim_product_id % 97 = 8 THEN 'nobody' ELSE 'clk' END AS factory,
        CASE WHEN dim_product_id % 101 = 9 THEN 'Someday' ELSE 'bulk buy' END AS buying_program FROM {product}""",
    "construction_type": """SELECT DISTINCT CASE WHEN dim_product_id % 50 = 3 THEN 'X ' ELSE construction_type END AS name FROM {product}""",
    "demand_category": """SELECT DISTINCT status AS name FROM {factory}""",
    "buying_program": """SELECT CASE WHEN dim_factory_id % 5 = 2 THEN 'ELSE' ELSE 'DEMAND' END AS brand, 'FOOTWEAR' AS product_line, 'any' AS category,
        CASE WHEN dim_factory_id % 7 = 3 THEN 'P' ELSE short_name END AS name FROM {factory}""",
    "factory_business": """SELECT 'DEMAND' AS brand, CASE WHEN dim_factory_id % 3 = 2 THEN 'HATS' ELSE 'FOOTWEAR' END AS product_line,
        lower(country_code) AS country, short_name, status FROM {factory}""",
    "customer_country": """SELECT customer_name AS name, CASE WHEN dim_customer_id % 40 = 6 THEN '99' ELSE CAST(dim_location_id AS VARCHAR(10)) END AS country,
        'Active' AS status FROM {customer}""",
}
SYNCED_MORE = ("construction_type", "demand_category", "buying_program", "factory_business", "customer_country")
BUSINESS = [("DEMAND", "FOOTWEAR")]


def _submitted(spark, m, name):
    return spark.sql((SUBMITTED | SUBMITTED_MORE)[name].replace("VARCHAR(10)", "STRING"), product=m.product, factory=m.factory, customer=m.customer)


def _rules(spark, m) -> dict[str, Rules]:
    programs = spark.createDataFrame(PROGRAM_ROWS, "name string, short string")
    party, mtl = m.customer.select("sold_to_party"), m.product.select("material_id")
    fty, cust = m.factory.select("short_name"), m.customer.select("customer_name")
    days = m.calendar.select("day_name_of_week")
    c = F.col
    total = sum((F.coalesce(c(x).cast("double"), F.lit(0.0)) for x in ("emea", "nora", "casa", "apac")), F.lit(0.0))
    return {
        "retail_qt": Rules(["sold_to_party", "mtl", "factory", "buying_program"], ["sold_to_party", "status", "mtl", "factory", "buying_program"],
                           [Found(["sold_to_party"], party), Found(["mtl"], mtl, True), Found(["factory"], fty), Found(["buying_program"], programs.select("name"))],
                           [~F.upper("status").isin("DROPPED", "ACTIVE", "REJECTED")]),
        "fty_qt": Rules(["mtl", "factory"], ["mtl", "factory"], [Found(["mtl"], mtl, True), Found(["factory"], fty)]),
        "avg_fob": Rules(["factory", "mtl"], ["mtl", "factory"], [Found(["mtl"], mtl, True), Found(["factory"], fty)]),
        "cutoff": Rules(["port"], ["country", "port", "day_dc", "day_crossdock"],
                        [Found(["country"], m.factory.select("country_code")), Found(["day_dc"], days), Found(["day_crossdock"], days)]),
        # kept as specified: programs are looked up, yet their type is not among the known ones
        "mapping": Rules(["type", "child"], ["type", "parent", "child"],
                         [Found(["parent"], fty, True, c("type") == "Factory Master"), Found(["parent"], cust, True, c("type") == "Customer Master"),
                          Found(["parent"], programs.select("name"), True, c("type") == "Buying Program Master"),
                          Found(["parent"], m.product.select("construction_type"), True, c("type") == "Construction Type Master")],
                         [~c("type").isin("Factory Master", "Customer Master", "Construction Type Master"), c("parent") == c("child")]),
        "moq_policy": Rules(["product_type", "from_region", "from_customer"], ["product_type"],
                            [Found(["product_type"], m.product.select("construction_type"), True, ~F.upper("product_type").isin("REGULAR", "VAULT"))]),
        "label_upcharge": Rules(["customer", "product_type"], ["customer", "product_type"], [Found(["customer"], cust)],
                                [~F.upper("product_type").isin("SHOES", "SANDAL", "ALL"), ~c("upcharge").between(0, 1)]),
        "capacity_by_region": Rules(["factory"], ["factory"], [Found(["factory"], fty)], [F.abs(total - 1) >= 1e-9]),
        "capacity_adjustment": Rules(["factory"], ["factory"], [Found(["factory"], fty)]),
        "location": Rules(["region", "country"], ["region", "country", "code2"], [], [~c("region").isin("NORA", "CASA", "EMEA", "APAC"), F.length("code2") != 2]),
        "factory": Rules(["brand", "short_name"], ["brand", "country", "short_name", "status"], [Found(["country"], m.factory.select("country_code"))],
                         [~F.upper("status").isin("ACTIVE", "INACTIVE")]),
        "customer": Rules(["name"], ["name"], [], [~F.upper("status").isin("ACTIVE", "INACTIVE")]),
        "empty": Rules(["mtl", "factory"], ["mtl", "factory"], [Found(["mtl"], mtl, True), Found(["factory"], fty)]),
    }


def v20_master_rules(spark, sf_dir):
    """V20-V27, V29-V31, V35 and the status checks of V38 and V39: the verdict on every submitted master table."""
    m = Model(spark, sf_dir)
    rules, out = _rules(spark, m), None
    for name in SUBMITTED:
        df = _submitted(spark, m, name)
        if name == "retail_qt":
            df = master.expand_short_names(df, "buying_program", spark.createDataFrame(PROGRAM_ROWS, "name string, short string"))
        v = master.verdict(df, rules[name], name in SYNCED).select(F.lit(name).alias("master_table"), "*")
        out = v if out is None else out.unionByName(v)
    return out


def _rules_more(spark, m) -> dict[str, Rules]:
    programs = spark.createDataFrame(PROGRAM_ROWS, "name string, short string").select("name")
    business = Found(["brand", "product_line"], spark.createDataFrame(BUSINESS, "brand string, product_line string"), True)
    short = F.length(F.rtrim("name")) < 2
    status = ~F.upper("status").isin("ACTIVE", "INACTIVE")
    return {
        "prebuild": Rules(["region", "mtl", "size", "factory", "buying_program"], ["region", "mtl", "size", "factory", "buying_program"],
                          [Found(["region"], m.customer.select("region")), Found(["factory"], m.factory.select("short_name")), Found(["buying_program"], programs),
                           Found(["mtl", "size"], m.product.select("material_id", "production_lt"), True)]),
        "construction_type": Rules(["name"], ["name"], [], [short]),
        "demand_category": Rules(["name"], ["name"], [], [short]),
        "buying_program": Rules(["brand", "product_line", "name"], ["brand", "product_line", "category", "name"], [business], [short]),
        "factory_business": Rules(["brand", "product_line", "short_name"], ["brand", "product_line", "country", "short_name", "status"],
                                  [business, Found(["country"], m.factory.select("country_code"))], [status]),
        "customer_country": Rules(["name"], ["name"], [Found(["country"], m.customer.select("dim_location_id"))], [status]),
    }


def v28_master_rules(spark, sf_dir):
    """V28 prebuild, V37 names and the program's business, V38 the factory's business, V39 the customer's country."""
    m = Model(spark, sf_dir)
    rules, out = _rules_more(spark, m), None
    for name in SUBMITTED_MORE:
        v = master.verdict(_submitted(spark, m, name), rules[name], name in SYNCED_MORE).select(F.lit(name).alias("master_table"), "*")
        out = v if out is None else out.unionByName(v)
    return out


def v39_customer_location(spark, sf_dir):
    """Customers of known countries with their location's id, counted by id."""
    m = Model(spark, sf_dir)
    known = m.customer.select("dim_location_id", F.upper(F.col("dim_location_id").cast("string")).alias("known")).distinct()
    sent = _submitted(spark, m, "customer_country").join(known, F.upper("country") == F.col("known"))
    return sent.groupBy("dim_location_id").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first_name"))


_IN = {"product": "product", "factory": "factory", "customer": "customer"}


def _twin(name, key, label, bad, expand=False):
    src = (SUBMITTED | SUBMITTED_MORE)[name].format(**_IN)
    if expand:
        src = f"SELECT * REPLACE (CASE trim(buying_program) WHEN 'BB' THEN 'Bulk Buy' WHEN 'RQT' THEN 'Retail Quick Turn' ELSE buying_program END AS buying_program) FROM ({src}) e"
    text = " || ' / ' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in label)
    dup = "FALSE" if name in SYNCED + SYNCED_MORE else "n_keys < n_rows"
    return f"""SELECT '{name}' AS master_table, n_rows, n_keys, n_bad, first_bad,
      CASE WHEN n_rows = 0 THEN 'Table is empty.' WHEN n_bad > 0 THEN 'Row ' || first_bad || ' is invalid.'
           WHEN {dup} THEN 'Duplicated {'/'.join(key)} combinations.' ELSE 'ok' END AS outcome
      FROM (SELECT count(*) AS n_rows, count(DISTINCT ({', '.join(key)})) AS n_keys, count(CASE WHEN bad THEN 1 END) AS n_bad,
                   min(CASE WHEN bad THEN {text} END) AS first_bad
            FROM (SELECT s.*, coalesce({bad}, FALSE) AS bad FROM ({src}) s) b) a"""


_MTL = "NOT EXISTS (SELECT 1 FROM product p WHERE p.material_id = s.mtl)"
_FTY = "NOT EXISTS (SELECT 1 FROM factory f WHERE upper(f.short_name) = upper(s.factory))"
_PROGRAMS = ", ".join(repr(n.upper()) for n in BUYING_PROGRAMS.values())
_TWINS = [
    _twin("retail_qt", ["sold_to_party", "mtl", "factory", "buying_program"], ["sold_to_party", "status", "mtl", "factory", "buying_program"],
          f"""NOT EXISTS (SELECT 1 FROM customer c WHERE upper(c.sold_to_party) = upper(s.sold_to_party)) OR {_MTL} OR {_FTY}
              OR upper(s.buying_program) NOT IN ({_PROGRAMS}) OR upper(status) NOT IN ('DROPPED', 'ACTIVE', 'REJECTED')""", True),
    _twin("fty_qt", ["mtl", "factory"], ["mtl", "factory"], f"{_MTL} OR {_FTY}"),
    _twin("avg_fob", ["factory", "mtl"], ["mtl", "factory"], f"{_MTL} OR {_FTY}"),
    _twin("cutoff", ["port"], ["country", "port", "day_dc", "day_crossdock"],
          """upper(s.country) NOT IN (SELECT upper(country_code) FROM factory)
             OR upper(s.day_dc) NOT IN ('SUNDAY', 'MONDAY', 'TUESDAY', 'WEDNESDAY', 'THURSDAY', 'FRIDAY', 'SATURDAY')
             OR upper(s.day_crossdock) NOT IN ('SUNDAY', 'MONDAY', 'TUESDAY', 'WEDNESDAY', 'THURSDAY', 'FRIDAY', 'SATURDAY')"""),
    _twin("mapping", ["type", "child"], ["type", "parent", "child"],
          """(s.type = 'Factory Master' AND s.parent NOT IN (SELECT short_name FROM factory))
             OR (s.type = 'Customer Master' AND s.parent NOT IN (SELECT customer_name FROM customer))
             OR s.type NOT IN ('Factory Master', 'Customer Master', 'Construction Type Master') OR s.parent = s.child"""),
    _twin("moq_policy", ["product_type", "from_region", "from_customer"], ["product_type"],
          "upper(s.product_type) NOT IN ('REGULAR', 'VAULT') AND s.product_type NOT IN (SELECT construction_type FROM product)"),
    _twin("label_upcharge", ["customer", "product_type"], ["customer", "product_type"],
          """NOT EXISTS (SELECT 1 FROM customer c WHERE upper(c.customer_name) = upper(s.customer))
             OR upper(s.product_type) NOT IN ('SHOES', 'SANDAL', 'ALL') OR coalesce(s.upcharge NOT BETWEEN 0 AND 1, FALSE)"""),
    _twin("capacity_by_region", ["factory"], ["factory"], f"{_FTY} OR abs(coalesce(emea, 0) + coalesce(nora, 0) + coalesce(casa, 0) + coalesce(apac, 0) - 1) >= 1e-9"),
    _twin("capacity_adjustment", ["factory"], ["factory"], _FTY),
    _twin("location", ["region", "country"], ["region", "country", "code2"], "s.region NOT IN ('NORA', 'CASA', 'EMEA', 'APAC') OR length(s.code2) <> 2"),
    _twin("factory", ["brand", "short_name"], ["brand", "country", "short_name", "status"],
          "upper(s.country) NOT IN (SELECT upper(country_code) FROM factory) OR upper(s.status) NOT IN ('ACTIVE', 'INACTIVE')"),
    _twin("customer", ["name"], ["name"], "upper(s.status) NOT IN ('ACTIVE', 'INACTIVE')"),
    _twin("empty", ["mtl", "factory"], ["mtl", "factory"], f"{_MTL} OR {_FTY}"),
]
_BUSINESS = "(s.brand <> 'DEMAND' OR s.product_line <> 'FOOTWEAR')"
_TWINS_MORE = [
    _twin("prebuild", ["region", "mtl", "size", "factory", "buying_program"], ["region", "mtl", "size", "factory", "buying_program"],
          f"""upper(s.region) NOT IN (SELECT upper(region) FROM customer) OR {_FTY} OR upper(s.buying_program) NOT IN ({_PROGRAMS})
              OR NOT EXISTS (SELECT 1 FROM product p WHERE p.material_id = s.mtl AND CAST(p.production_lt AS VARCHAR) = s.size)"""),
    _twin("construction_type", ["name"], ["name"], "length(rtrim(s.name)) < 2"),
    _twin("demand_category", ["name"], ["name"], "length(rtrim(s.name)) < 2"),
    _twin("buying_program", ["brand", "product_line", "name"], ["brand", "product_line", "category", "name"], f"{_BUSINESS} OR length(rtrim(s.name)) < 2"),
    _twin("factory_business", ["brand", "product_line", "short_name"], ["brand", "product_line", "country", "short_name", "status"],
          f"{_BUSINESS} OR upper(s.country) NOT IN (SELECT upper(country_code) FROM factory) OR upper(s.status) NOT IN ('ACTIVE', 'INACTIVE')"),
    _twin("customer_country", ["name"], ["name"],
          "s.country NOT IN (SELECT CAST(dim_location_id AS VARCHAR) FROM customer) OR upper(s.status) NOT IN ('ACTIVE', 'INACTIVE')"),
]
query("v28_master_rules", sql("\nUNION ALL\n".join(_TWINS_MORE), "product", "factory", "customer"))(v28_master_rules)
query("v39_customer_location", sql("""
SELECT dim_location_id, count(*) AS n, min(customer_name) AS first_name
FROM customer WHERE dim_customer_id % 40 <> 6 GROUP BY 1""", "customer"))(v39_customer_location)
query("v20_master_rules", sql("\nUNION ALL\n".join(_TWINS), "product", "factory", "customer"))(v20_master_rules)


def v20_customer_sync(spark, sf_dir):
    """V20/V39 sync of the customer table: repeated names reduced, absent names deleted, new ones inserted, others updated,
    the status text as ``is_active``."""
    m = Model(spark, sf_dir)
    k = F.col("dim_customer_id")
    current = m.customer.filter(k % 4 != 0).select(F.col("customer_name").alias("name"), F.lit(1).alias("is_active"), F.lit("old").alias("note"))
    sent = _submitted(spark, m, "customer").join(m.customer.filter(k % 5 != 0).select(F.col("customer_name").alias("name")), "name", "left_semi")
    new, _ = master.sync(current, sent.select("name", master.active_flag(F.col("status")).alias("is_active")),
                         Rules(["name"], ["name"], [], [~F.col("is_active").isin(0, 1)]))
    return new.groupBy("action", "is_active", "note").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first_name"))


query("v20_customer_sync", sql("""
SELECT CASE WHEN dim_customer_id % 4 <> 0 THEN 'update' ELSE 'insert' END AS action,
       CASE WHEN dim_customer_id % 2 = 0 THEN 1 ELSE 0 END AS is_active, CASE WHEN dim_customer_id % 4 <> 0 THEN 'old' END AS note,
       count(*) AS n, min(customer_name) AS first_name
FROM customer WHERE dim_customer_id % 5 <> 0 GROUP BY 1, 2, 3""", "customer"))(v20_customer_sync)


def v32_configuration(spark, sf_dir):
    """V32 configuration variables (one row per variable, here from the regions' figures) as one row of columns."""
    m = Model(spark, sf_dir)
    config = m.customer.groupBy(F.concat(F.lit("n_"), "region").alias("variable")).agg(F.count(F.lit(1)).cast("string").alias("value"))
    return master.configuration_row(config, ["n_NORA", "n_CASA", "n_EMEA", "n_APAC", "n_none"])


query("v32_configuration", sql("""
SELECT CAST(count(*) FILTER (region = 'NORA') AS VARCHAR) AS "n_NORA", CAST(count(*) FILTER (region = 'CASA') AS VARCHAR) AS "n_CASA",
       CAST(count(*) FILTER (region = 'EMEA') AS VARCHAR) AS "n_EMEA", CAST(count(*) FILTER (region = 'APAC') AS VARCHAR) AS "n_APAC",
       CAST(NULL AS VARCHAR) AS n_none FROM customer""", "customer"))(v32_configuration)
