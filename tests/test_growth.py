"""Steps whose work once grew faster than their input."""

import os
import re
from functools import reduce

import pytest
from pyspark.sql import functions as F

from conftest import SF
from quartermaster.operators import allocate, capacity, loads, lookups, merge, reshape
from quartermaster.operators.validate import Check, suite_values
from quartermaster.plans import catalog, model, q_allocate  # noqa: F401
from quartermaster.plans.model import Model
from quartermaster.plans.registry import QUERIES
from quartermaster.session import ensure_checkpoint_dir


def test_correlated_max_meets_no_pairs(spark):
    n = 4000
    df = spark.range(n).selectExpr("id", "'one' AS g", "CAST(id % 50 AS INT) AS s", "CAST((id * 7919) % 4001 AS DOUBLE) AS v")
    nulls = spark.createDataFrame([(-1, None, 5, 1.0), (-2, "one", None, 1.0)], "id long, g string, s int, v double")
    df = df.unionByName(nulls)
    rules = df.select(F.col("g").alias("rg"), F.col("s").alias("rs"), "v")
    out = lookups.correlated_max(df, rules, [("g", "rg")], ("s", "rs"), F.col("v"), "best")
    rows = df.collect()
    best = {s: max([r["v"] for r in rows if r["g"] == "one" and r["s"] is not None and r["s"] < s], default=None) for s in range(50)}
    got = out.collect()
    assert out.columns == [*df.columns, "best"] and len(got) == n + 2
    assert all(r["best"] == (best[r["s"]] if r["id"] >= 0 else None) for r in got)
    # the group's rows join their places, one for each size, not each other
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_at" in plan and " < " not in plan


def _written(spark, build) -> int:
    """Bytes that a builder leaves in the shared scratch folder."""
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")

    def size():
        return sum(os.path.getsize(os.path.join(at, f)) for at, _dirs, files in os.walk(folder) for f in files)
    before = size()
    build(spark, SF)
    return size() - before


@pytest.fixture()
def plain(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["x_allocate_unconstrained", "x_allocation_summary"])
def test_lines_are_not_dealt_by_customer_or_material(plain, name):
    """Lines are dealt by order, by product, region and party, and by product; orders meet the customers first."""
    plan = QUERIES[name](plain, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(o_custkey" in plan and not re.search(r"hashpartitioning\(material_id#\d+, region#\d+, party#", plan)


@pytest.mark.parametrize("name", ["x_allocate_constrained", "x_constrained_loops"])
def test_constrained_pass_writes_little(spark, name):
    lines = Model(spark, SF).table("lineitem").count()
    assert _written(spark, QUERIES[name]) < 60 * lines


def test_tasks_grow_with_the_lines(spark, monkeypatch):
    monkeypatch.setattr(model, "TASK_LINES", 100)
    m = Model(spark, SF)
    assert m.parts == m.table("lineitem").count() // 100 == m.capacity.rdd.getNumPartitions() == m.demand.rdd.getNumPartitions()


def test_pivot_deals_groups_to_the_tasks_asked_for(spark):
    df = spark.range(600).selectExpr("id % 50 AS k", "concat('w', id % 3) AS w", "id AS v")
    out = reshape.pivot_generic(df, ["k"], "w", ["w0", "w1", "w2"], "v", 30)
    assert out.rdd.getNumPartitions() == 30 and out.count() == 50
    assert out.agg(F.sum(F.col("w0") + F.col("w1") + F.col("w2"))).first()[0] == sum(range(600))


def test_checks_are_spelt_out_once(plain):
    """However many suites hold a check, a row makes its texts once and sorts neither for the products nor for the references."""
    lines = QUERIES["v10_load_suites"](plain, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    made = [line for line in lines if "Generate explode" in line and "_t0" in line]
    assert len(made) == 2 and not any("VN??" in line or "day " in line for line in made)
    assert not any("Sort [dim_product_id" in line or "Sort [reference" in line for line in lines)


def test_suite_values_keep_nulls_sources_and_checks_apart(spark):
    rows = spark.createDataFrame([("a", "x", "1"), ("a", None, "zz"), ("a", "x", "1"), ("b", "x", "zz"), ("b", "", None), ("other", "q", "q"), (None, "q", "q")], "s string, t string, d string")
    t, d = F.col("t"), F.col("d")
    known = Check("known", t, t, "names")
    pair = Check("pair", t, F.concat(t, F.lit("|"), d), "pairs")
    number = Check("number", d, broken=lambda x: x.try_cast("int").isNull())
    got = {tuple(r) for r in suite_values(rows, F.col("s"), {"a": [known, pair], "b": [known, number]}).collect()}
    assert got == {("a", "known", "names", "x", "x"), ("a", "known", "names", None, ""), ("a", "pair", "pairs", "x|1", "x"), ("a", "pair", "pairs", None, ""),
                   ("b", "known", "names", "x", "x"), ("b", "known", "names", "", ""), ("b", "number", None, None, "zz"), ("b", "number", None, None, "")}


def test_staged_rows_meet_all_products_of_a_material_at_once(spark):
    staged = spark.createDataFrame([(1, "M1-long-name", "8"), (2, "M1", "8"), (3, "M1", "9"), (4, "M1", None), (5, "M2", "8"), (6, "M3", "8"), (7, None, "8"), (8, "M4", "8")],
                                   "row int, material_id string, size string")
    products = spark.createDataFrame([("M1", "8", 11), ("M1", "8", 12), ("M1", None, 19), ("M1", "9", None), ("M4", "8", 41), (None, "8", 99)], "material_id string, size string, id int")
    materials = spark.createDataFrame([("M1", 10, 110), ("M1", 9, 70), ("M2", 20, None), (None, 90, 1)], "material_id string, id int, production_lt int")
    got = {(r["row"], r["material_id"], r["dim_product_id"], r["production_lt"]) for r in loads.resolve_product(staged, products, materials, 2).collect()}
    assert got == {(1, "M1-long-name", 12, 110), (2, "M1", 12, 110), (3, "M1", 10, 110), (4, "M1", 10, 110), (5, "M2", 20, None), (8, "M4", 41, None)}


def test_need_to_buy_rows_are_dealt_once_by_material(plain):
    plan = QUERIES["l10_whole_facts"](plain, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(_mtl#\d+, size#", plan)
    # rows without a Monday are gone before the others are dealt by customer
    dealt = [line for line in plan.splitlines() if re.search(r"hashpartitioning\(customer_text#", line)]
    assert len(dealt) == 4 and "_monday" in plan.split("hashpartitioning(customer_text#")[1]


def test_lookups_by_the_same_columns_are_one_join(plain):
    df = plain.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,)], "t string")
    first = plain.createDataFrame([("a", 1), ("a", 2), ("b", None)], "k string, id int")
    second = plain.createDataFrame([("a", 10), ("b", 20), ("c", 30), (None, 40)], "name string, other long")
    third = plain.createDataFrame([(7, 70)], "n int, id int")
    out = lookups.resolve(df, [(first, [("t", "k")], "id"), (second, [("t", "name")], "other"), (third.selectExpr("cast(n as string) AS n", "id"), [("t", "n")], "id")], "found", placeholder=-1)
    assert {tuple(r) for r in out.collect()} == {("a", 2), ("b", 20), ("c", 30), ("d", -1), (None, -1)} and out.columns == ["t", "found"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1


def test_capacity_load_deals_rows_once_by_factory(plain):
    """Daily and weekly capacity are dealt by factory, then summed, adjusted and merged where they are."""
    plan = QUERIES["l34_capacity_load"](plain, SF)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*\)?[^)]*), \d+\)", plan)
    assert sum(bool(re.match(r"(coalesce\()?dim_factory_id#\d+L?, .*(region|dim_date_id|year)#", d)) for d in dealt) == 0
    assert plan.count("Window") == 1 and "FullOuter" not in plan


def test_weekly_sums_stand_on_the_first_day_only(spark):
    cal = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, "B")], "id int, year_cw_accounting string")
    rows = [(7, "R", "T", 1, 1.0, 0.5), (7, "R", "T", 2, 2.0, None), (7, "R", "T", 4, 4.0, 4.0), (7, "R", "T", 9, 8.0, 8.0), (7, "S", "T", 1, 16.0, None),
            (None, "R", "T", 1, 32.0, 1.0), (8, "R", "T", None, 64.0, 1.0)]
    daily = spark.createDataFrame(rows, "dim_factory_id long, region string, construction_type string, dim_date_id int, capacity_raw_daily double, capacity_raw_daily_overwritten double")
    out = capacity.weekly_rollup(daily, cal)
    assert out.columns == [*daily.columns, "capacity_raw_weekly", "capacity_raw_weekly_overwritten"]
    assert {tuple(r)[:4]: tuple(r)[6:] for r in out.collect()} == {r[:4]: {(7, "R", 1): (3.0, 0.5), (7, "S", 1): (16.0, None)}.get((r[0], r[1], r[3]), (None, None)) for r in rows}


def test_upsert_by_aggregate_equals_the_join(plain):
    target = plain.createDataFrame([(1, "a", 1.0, "x"), (2, None, 2.0, "y"), (None, "c", 3.0, None), (4, "d", None, "z")], "k long, n string, v double, t string")
    source = plain.createDataFrame([(2, None, 20.0), (None, "c", None), (4, "d", 40.0), (5, None, 50.0)], "k long, n string, v double")
    want = merge.upsert(target, source, ["k", "n"])
    got = merge.upsert_keyed(target, source, ["k", "n"])
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 5
    sides = [df.repartition(6, "k") for df in (target, source)]
    plan = merge.upsert_keyed(*sides, ["k", "n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_constrained_pass_deals_lines_to_orders_once(plain):
    """The lines that met their orders are written and read again; those without units are not dealt by write-back key."""
    df = QUERIES["x_allocate_constrained"](plain, SF)
    assert not any("lineitem" in f or "orders" in f for f in df.inputFiles())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and len(re.findall(r"Exchange hashpartitioning\(program#\d+, material_id#", plan)) <= 3
    assert not re.search(r"hashpartitioning\(coalesce\(dim_factory_id_original_unconstrained#", plan)


def test_units_without_a_rule_hold_no_features(spark):
    m = Model(spark, SF)
    lines = q_allocate._open_lines(m, q_allocate._with_customers(m), m.retail_qt)
    units, _load = allocate.demand_units(lines, m.factory, m.capacity, m.calendar)
    held = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in allocate.UNIT_ATTRS])
    got = units.groupBy("_ruled").agg(F.count(F.when(held, 1)).alias("held"), F.count(F.lit(1)).alias("n")).collect()
    assert {r["_ruled"]: r["held"] for r in got} == {True: next(r["n"] for r in got if r["_ruled"]), False: 0}
    assert units.select(F.sum("quantity")).first() == lines.select(F.sum("quantity")).first()


def test_lines_meet_quick_turn_vendors_with_their_product(plain):
    m = Model(plain, SF)
    product = plain.createDataFrame([(1, "M1", "Flex", "T", 0, 0, 0), (2, "M1", "Flex", "T", 0, 0, 0), (3, "M3", "Flex", "T", 0, 0, 0)],
                                    "dim_product_id long, material_id string, style_complexity string, construction_type string, clk_mtl int, dtp_mtl int, sjd_mtl int")
    vendors = plain.createDataFrame([("M1", "EMEA", "EU DC", "CLK"), ("M1", "EMEA", "EU DC", "DTC"), ("M1", "NORA", "US DC", "SJV"), ("M1", "EMEA", None, "SJD"), ("M1", None, "US DC", "SJD")],
                                    "material_id string, region string, sold_to_party string, factory_short_name string")
    rows = [(1, 1, "EMEA", "EU DC"), (2, 2, "NORA", "US DC"), (3, 1, "NORA", "EU DC"), (4, 1, "EMEA", None), (5, 1, None, "US DC"), (6, 3, "EMEA", "EU DC"), (7, 9, "EMEA", "EU DC"), (8, None, "EMEA", "EU DC")]
    lines = plain.createDataFrame(rows, "line_id long, dim_product_id long, region string, party string").withColumns(
        {"buying_program": F.lit("Retail Quick Turn"), "demand_date": F.current_date(), "release_date": F.current_date()})
    out = allocate.allocation_features(lines, product, None, m.factory, m.priority, m.fty_qt, vendors)
    ids = {r["short_name"]: r["dim_factory_id"] for r in m.factory.select("short_name", "dim_factory_id").collect()}
    got = {r["line_id"]: (r["rqt_vendor"], r["rqt_vendor_id"]) for r in out.select("line_id", "rqt_vendor", "rqt_vendor_id").collect()}
    assert got == {n: (v, ids.get(v)) for n, v in zip(range(1, 9), ["DTC", "SJV", *[None] * 6])}
    assert not re.search(r"hashpartitioning\(dim_product_id#\d+L?, region#", out._jdf.queryExecution().executedPlan().toString())
