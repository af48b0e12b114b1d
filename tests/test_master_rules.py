"""Rules of the submitted master tables that no query checked before."""

from conftest import SF

from __spark_entry__ import queries


def test_rows_that_break_the_rules_are_found(spark):
    got = {r["master_table"]: r for r in queries()["v28_master_rules"](spark, SF).collect()}
    for name in ("prebuild", "construction_type", "buying_program", "factory_business", "customer_country"):
        assert got[name]["n_bad"] > 0 and got[name]["outcome"].endswith("is invalid."), name
    assert got["demand_category"]["outcome"] == "ok"
