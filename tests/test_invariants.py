"""Invariants of the flagship operators: calendar gap-free, allocation keeps quantity,
one factory per line, extra-week rule, rank helpers."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF
from quartermaster.operators import calendar, rank
from quartermaster.plans import q_allocate
from quartermaster.plans.model import Model


def test_calendar_gap_free_and_weeks(spark):
    cal = calendar.fiscal_calendar(spark, "1995-01-01", "1999-12-31", 1, 12)
    r = cal.agg(F.count("*").alias("n"), F.count_distinct("id").alias("d"), F.min("full_date").alias("lo"),
                F.max("full_date").alias("hi"), F.max("week_accounting").alias("w")).first()
    assert r.n == r.d == (r.hi - r.lo).days + 1
    assert r.w == 52          # extra month 12 never adds a 53rd week
    weeks = cal.groupBy("year_cw_accounting").count().filter("count <> 7").count()
    assert weeks <= 1         # only the last, cut week may be short
    assert cal.filter(F.col("day_of_week") == 1).agg(F.min("week_accounting")).first()[0] == 1


def test_calendar_extra_week_in_october():
    years = calendar.fiscal_years(dt.date(1995, 1, 1), dt.date(2030, 1, 1), 1, 10)
    assert any(w == 53 for _fy, _d, w, _e, _s in years)
    # consecutive fiscal years are contiguous
    for (a, d1, w, _e, _s), (_b, d2, _w2, _e2, _s2) in zip(years, years[1:]):
        assert (d2 - d1).days == 7 * w


def test_fiscal_start_nearest_sunday():
    assert calendar.fiscal_start(dt.date(2010, 1, 1), 1) == dt.date(2010, 1, 3)   # Friday -> next Sunday
    assert calendar.fiscal_start(dt.date(1995, 1, 1), 1) == dt.date(1995, 1, 1)   # already Sunday


def test_allocation_keeps_quantity_and_one_factory(spark):
    m = Model(spark, SF)
    u = q_allocate.unconstrained(spark, SF)
    total = m.demand.agg(F.sum("quantity")).first()[0]
    assert u.agg(F.sum("quantity")).first()[0] == total
    assert u.filter(F.col("dim_factory_id_original_unconstrained").isNull()).count() == 0
    assert u.count() == m.demand.count()


def test_global_rank_matches_window(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 3, 5, 1, 9, 3, 3, 7])], "k int, v int")
    got = {r.k: r.rank for r in rank.global_rank(df, "v", partitions=3).collect()}
    vals = [5, 3, 5, 1, 9, 3, 3, 7]
    want = {i: 1 + sum(1 for x in vals if x > v) for i, v in enumerate(vals)}
    assert got == want


def test_dedupe_keeps_smallest(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "z", 1)], "k int, s string, n int")
    got = sorted(tuple(r) for r in rank.dedupe(df, ["k"]).collect())
    assert got == [(1, "a", 9), (2, "z", 1)]
