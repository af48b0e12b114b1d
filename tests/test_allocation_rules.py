"""The unconstrained rules leaf by leaf: expected factory and log written out by hand from the procedures."""

import pytest
from pyspark.sql import functions as F

from quartermaster.operators import rules

IDS = {"CLK": 1, "DTC": 2, "DTP": 3, "SJD": 4, "SJV": 5, "HSC": 6, "ICC": 7, "AAA": 8, "BBB": 9}
COLUMNS = ("clk int, dtp int, sjd int, flex boolean, single boolean, c1 string, c2 string, p1 string, p2 string, p1_id bigint, p2_id bigint, "
           "id_clk bigint, id_dtc bigint, id_dtp bigint, id_sjd bigint, id_sjv bigint, id_hsc bigint, cust_name string, party string, "
           "rqt_vendor string, rqt_vendor_id bigint")

# (rule, features that differ from the default, factory, log)
CASES = [
    ("X10", dict(clk=1, dtp=1), "CLK", "CLK MTL"), ("X10", dict(dtp=1, flex=True), "DTP", "DTP MTL"), ("X10", dict(flex=True), "SJV", "Flex"),
    ("X10", dict(single=True), "AAA", "Single Source => 1st priority"),
    ("X10", dict(c1="CN"), "BBB", "1st priority = COO China => 2nd priority => BBB"),
    ("X10", dict(c1="CN", p2=None), "AAA", "1st priority = COO China => 2nd priority => not found => 1st priority => AAA"),
    ("X10", dict(c1="VN"), "AAA", "1st priority = COO not China => 1st priority => AAA"),
    ("X10", dict(p1=None), None, "1st priority = COO not China => 1st priority => Not found"),
    ("X11", dict(clk=1), "CLK", "CLK MTL"), ("X11", {}, "AAA", "Single source => 1st priority => AAA"),
    ("X11", dict(p1=None), None, "Single source => 1st priority => Not found"),
    ("X12", dict(clk=1, flex=True), "CLK", "CLK MTL"), ("X12", dict(flex=True), "SJV", "Flex"), ("X12", dict(single=True), "AAA", "Single Source"),
    ("X12", dict(c1="CN"), "BBB", "1st priority = COO China => 2nd priority => BBB"),
    ("X12", dict(c1="CN", p2=None), "AAA", "1st priority = COO China => 2nd priority => not found => 1st priority => AAA"),
    ("X12", dict(c1="VN"), "AAA", "1st priority = COO not China => First priority => AAA"),
    ("X13", dict(sjd=1, cust_name="US Direct ZUMIEZ"), "SJD", "SJD MTL"), ("X13", dict(sjd=1, cust_name="US Direct"), "AAA", "First priority => AAA"),
    ("X14", dict(sjd=1), "SJD", "SJD MTL"), ("X14", {}, "AAA", "First priority => AAA"), ("X14", dict(p1=None), None, "First priority => Not found"),
    ("X15", dict(flex=True, clk=1), "SJV", "Flex"), ("X15", dict(clk=1, dtp=1), "CLK", "CLK MTL"), ("X15", dict(dtp=1), "DTP", "DTP MTL"),
    ("X15", dict(single=True), "AAA", "Single Source"), ("X15", dict(c1="CN", c2="CN"), "AAA", "2nd priority = COO China => First priority => AAA"),
    # the procedure's log names China on this branch too; ours logs the branch really taken (README, Q7)
    ("X15", dict(c1="VN"), "AAA", "1st priority = COO not China => First priority => AAA"),
    ("X19", {}, "AAA", "First priority => AAA"), ("X19", dict(p1=None), None, "First priority => Not found"),
    ("X05", dict(rqt_vendor="DTC", rqt_vendor_id=2), "DTC", "DTC RQT MTL"),
]


def row(**own):
    f = dict(clk=0, dtp=0, sjd=0, flex=False, single=False, c1="US", c2="US", p1="AAA", p2="BBB", cust_name="x", party="x", rqt_vendor=None, rqt_vendor_id=None)
    f.update(own)
    f.update({f"id_{k.lower()}": IDS[k] for k in ("CLK", "DTC", "DTP", "SJD", "SJV", "HSC")}, p1_id=IDS.get(f["p1"]), p2_id=IDS.get(f["p2"]))
    return tuple(f[c.split()[0]] for c in COLUMNS.split(", "))


@pytest.mark.parametrize("rule", sorted({c[0] for c in CASES}))
def test_leaves(spark, rule):
    cases = [c for c in CASES if c[0] == rule]
    fid, log, _ = rules.rule_case(rule)
    df = spark.createDataFrame([row(**c[1]) for c in cases], COLUMNS).coalesce(1)
    got = [(r["f"], r["l"].removeprefix(" => ")) for r in df.select(F.expr(fid).alias("f"), F.expr(log).alias("l")).collect()]
    assert got == [(IDS.get(c[2]), c[3]) for c in cases]


# constrained rules (X30-X39), each loop, written out by hand from the procedures; the unit's factory now is 99
UNIT = "fname string, f_region string, in_rqt boolean"
V = dict(in_rqt=True, rqt_vendor="AAA", rqt_vendor_id=8)
NON = "[loop: {}] => Non-duty Beneficial: {} => {}"
DUTY = "[loop: {}] => Duty Beneficial: {} => {}"
LOOP_CASES = [
    ("CLK", 1, dict(party="US DC", dual=True), "BBB", NON.format(1, "US DC", "Dual Source => 2nd priorityBBB")),
    ("CLK", 1, dict(party="US DC", flex=True, p2=None), "AAA", NON.format(1, "US DC", "Dual Source => 2nd priority not found => 1st priority => AAA")),
    ("CLK", 1, dict(party="US DC", flex=True, p1=None, p2=None), None, NON.format(1, "US DC", "Dual Source => 2nd priority not found => 1st priority")),
    ("CLK", 1, dict(party="US DC", p2=None), "stay", "[loop: 1] => Non-duty Beneficial: US DC"),
    ("CLK", 1, dict(party="EU DC"), "stay", "[loop: 1] => not Non-Duty Beneficial"),
    ("CLK", 2, dict(party="EU DC", dtp=1), "DTP", DUTY.format(2, "EU DC", "DTP MTL")), ("CLK", 2, dict(party="EU DC"), "stay", DUTY.format(2, "EU DC", "Non DTP MTL => CLK")),
    ("CLK", 2, dict(party="India DC", f_region="APAC", **V), "AAA", DUTY.format(2, "India DC", "RQT MTL => AAA")),
    ("CLK", 2, dict(party="Korea DC", flex=True), "SJV", DUTY.format(2, "Korea DC", "Dual Source => Flex => SJV")),
    ("CLK", 2, dict(party="Canada Direct", dual=True), "BBB", DUTY.format(2, "Canada Direct", "Dual Source => Not Flex => 2nd priorityBBB")),
    ("CLK", 2, dict(party="Canada DC", p2=None), "stay", DUTY.format(2, "Canada DC", "Single Source => CLK")),
    ("CLK", 2, dict(party="US DC"), "stay", "[loop: 2]"), ("CLK", 3, dict(party="US DC"), "stay", ""),
    ("DTC", 1, dict(party="EU DC", flex=True), "SJV", NON.format(1, "EU DC", "Flex => SJV")),
    ("DTC", 1, dict(party="EU DC", dual=True), "BBB", NON.format(1, "EU DC", "Not Flex => Dual Source => 2nd priority => BBB")),
    ("DTC", 1, dict(party="EU DC", clk=1, dtp=1, p2=None), "AAA", NON.format(1, "EU DC", "Not Flex => Dual Source => 2nd priority => Not found => 1st priority => AAA")),
    ("DTC", 1, dict(party="EU DC", clk=1, dtp=1, p1=None, p2=None), "stay",
     NON.format(1, "EU DC", "Not Flex => Dual Source => 2nd priority => Not found => 1st priority => Not found => DTC")),
    ("DTC", 1, dict(party="EU DC", p2=None), "stay", NON.format(1, "EU DC", "Not Flex => DTC")), ("DTC", 1, dict(party="Chile DC"), "stay", "[loop: 1]"),
    ("DTC", 2, dict(party="Chile DC", f_region="EMEA", in_rqt=True, rqt_vendor="SJV", rqt_vendor_id=5), "DTC", DUTY.format(2, "Chile DC", "RQT MTL => DTC")),
    ("DTC", 2, dict(party="China DC", f_region="APAC", **V), "HSC", DUTY.format(2, "China DC", "RQT MTL => HSC")),
    ("DTC", 2, dict(party="China DC", flex=True, p1="DTC"), "stay", DUTY.format(2, "China DC", "Flex => 1st priority = DTC => DTC")),
    ("DTC", 2, dict(party="China DC", flex=True), "AAA", DUTY.format(2, "China DC", "Flex => 1st priority = not DTC => SJV")),
    ("DTC", 2, dict(party="China DC", flex=True, p1=None), None, DUTY.format(2, "China DC", "Flex => 1st priority = not DTC => SJV")),
    ("DTC", 2, dict(party="China DC"), "stay", DUTY.format(2, "China DC", "Not Flex => DTC")),
    ("DTP", 1, dict(party="EU DC", clk=1), "CLK", DUTY.format(1, "EU DC", "CLK MTL")),
    ("DTP", 1, dict(party="EU Crossdock", dual=True), "BBB", DUTY.format(1, "EU Crossdock", "Dual Source => 2nd priority => BBB")),
    ("DTP", 1, dict(party="EU DC", p2=None), "stay", "[loop: 1] => Duty Beneficial: EU DC"),
    ("DTP", 2, dict(party="Korea DC", flex=True), "SJV", DUTY.format(2, "Korea DC", "Flex => SJV")),
    ("DTP", 2, dict(party="Korea DC"), "AAA", DUTY.format(2, "Korea DC", "Not Flex => First priority => AAA")),
    ("DTP", 2, dict(party="Korea DC", p1=None), None, DUTY.format(2, "Korea DC", "Not Flex => First priority")),
    ("FSC", 1, dict(party="EU DC", p2=None), "stay", NON.format(1, "EU DC", "Not Flex => FSC")),
    ("FSC", 2, dict(party="China DC", flex=True), "SJV", DUTY.format(2, "China DC", "Flex => SJV")), ("FSC", 2, dict(party="China DC"), "stay", DUTY.format(2, "China DC", "Flex => FSC")),
    ("HSC", 2, dict(party="Chile DC", f_region="NORA", in_rqt=True, rqt_vendor="DTC", rqt_vendor_id=2), "SJV", DUTY.format(2, "Chile DC", "RQT MTL => SJV")),
    ("HSC", 2, dict(party="Chile DC"), "stay", DUTY.format(2, "Chile DC", "Flex => HSC")),
    ("ICC", 2, dict(party="Chile DC", flex=True, p1="ICC"), "stay", DUTY.format(2, "Chile DC", "Flex => 1st priority = ICC => ICC")),
    ("ICC", 2, dict(party="Chile DC", flex=True), "SJV", DUTY.format(2, "Chile DC", "Flex => 1st priority = not ICC => SJV")),
    ("SJD", 1, dict(party="US Direct", f_region="NORA", **V), "AAA", DUTY.format(1, "US Direct", "RQT MTL => AAA")),
    ("SJD", 1, dict(party="US Direct"), "SJV", DUTY.format(1, "US Direct", "not RQT MTL => SJV")), ("SJD", 1, dict(party="US DC"), "stay", "[loop: 1]"),
    ("SJD", 2, dict(party="US DC"), "stay", DUTY.format(2, "US DC", "not RQT MTL => SJD")),
    ("SJV", 1, dict(party="Chile DC", flex=True, p1="SJV"), "HSC", NON.format(1, "Chile DC", "1st priority = SJV => HSC => Flex => SJV")),
    ("SJV", 1, dict(party="Chile DC", flex=True), "AAA", NON.format(1, "Chile DC", "1st priority = not SJV => 1st priority => AAA => Flex => SJV")),
    ("SJV", 2, dict(party="China DC", f_region="APAC", **V), "AAA", NON.format(2, "China DC", "RQT MTL => HSC => Not Flex => 1st priority => AAA")),
    ("SJV", 3, dict(party="India DC", flex=True), "BBB", NON.format(3, "India DC", "Flex => Dual Source => 2nd priority => BBB")),
    ("SJV", 4, dict(party="EU Crossdock", flex=True, p2=None), "AAA", NON.format(4, "EU Crossdock", "Flex => Dual Source => 2nd priority => Not found => 1st priority => AAA")),
    ("SJV", 4, dict(party="EU DC", flex=True, p1=None, p2=None, f_region="APAC", **V), "AAA",
     NON.format(4, "EU DC", "RQT MTL => AAA => Flex => Dual Source => 2nd priority => Not found => 1st priority => Not found => SJV")),
    ("SJV", 5, dict(party="Korea Direct", flex=True), "stay", DUTY.format(5, "Korea Direct", "Flex => SJV")),
    ("SJV", 5, dict(party="Korea DC"), "AAA", DUTY.format(5, "Korea DC", "Not Flex => 1st priority => AAA")),
    ("SJV", 5, dict(party="Korea DC", p1=None), None, DUTY.format(5, "Korea DC", "Not Flex => 1st priority")), ("SJV", 3, dict(party="EU DC"), "stay", "[loop: 3]"),
    ("AAA", 1, dict(party="US DC"), "stay", ""),
]


@pytest.mark.parametrize("loop", [1, 2, 3, 4, 5])
def test_constrained_leaves(spark, loop):
    cases = [c for c in LOOP_CASES if c[1] == loop]
    rows = []
    for code, _, own, _, _ in cases:
        own = dict(own)
        dual = own.pop("dual", False)
        unit = code, own.pop("f_region", "EMEA"), own.pop("in_rqt", False)
        rows.append((*row(**own), 2 if dual else 1, *unit))
    df = spark.createDataFrame(rows, f"{COLUMNS}, n_src int, {UNIT}").coalesce(1)
    was_set, fid, log = rules.constrained_target(loop)
    df = df.withColumns({n: F.expr(e) for n, e in rules.unit_features().items()})
    got = df.select(F.when(F.expr(was_set), F.expr(fid)).otherwise(99).alias("f"), F.expr(log).alias("l")).collect()
    assert [(r["f"], r["l"].removeprefix(" => ")) for r in got] == [(99 if to == "stay" else IDS.get(to), text) for *_, to, text in cases]
