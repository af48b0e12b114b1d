"""Bands of any number against a plain test of every pair; lookups whose keys repeat."""

import random

import pytest

from quartermaster.operators import lookups


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("few", [0, 10_000])
def test_bands(spark, monkeypatch, how, few):
    monkeypatch.setattr(lookups, "FEW_BANDS", few)
    rnd = random.Random(3)
    top = 1 << 40
    bands = [(i, a, a + rnd.choice([0, 1, 15, 16, 255, 4096, top])) for i, a in enumerate(rnd.choice([rnd.randint(-300, 300), rnd.randint(-top, top)]) for _ in range(150))]
    bands += [(200, 5, 4), (201, None, 3), (202, -(1 << 50), 1 << 50)]
    values = [(i, rnd.choice([rnd.randint(-400, 400), rnd.randint(-top, 2 * top)])) for i in range(200)] + [(900, None), (901, 1 << 60), (902, 7), (902, 7)]
    df, b = spark.createDataFrame(values, "row long, v long"), spark.createDataFrame(bands, "band long, lo long, hi long")
    got = sorted(((r["row"], r["v"], r["band"]) for r in lookups.band_join(df, b, "v", "lo", "hi", how).collect()), key=str)
    want = []
    for i, v in values:
        hits = [k for k, lo, hi in bands if None not in (v, lo, hi) and lo <= v <= hi]
        want += [(i, v, k) for k in hits or ([None] if how == "left" else [])]
    assert got == sorted(want, key=str)


def test_a_repeated_lookup_key_does_not_multiply_rows(spark):
    df = spark.createDataFrame([("a",), ("b",)], "code string")
    lookup = spark.createDataFrame([("a", 1), ("a", 2)], "code string, id long")
    got = lookups.resolve(df, [(lookup, [("code", "code")], "id")], "out", placeholder=-1).collect()
    assert sorted(map(tuple, got)) == [("a", 2), ("b", -1)]
