"""Rules that a small data set does not exercise: ranks over many rows, long keys, NULL keys, dates outside the range."""

import pytest
from pyspark.sql import functions as F

from quartermaster.functions.text import pad_key
from quartermaster.operators import merge, rank, validate
from quartermaster.plans.model import Model


@pytest.mark.parametrize("partitions", [1, 2, 4, 16, 200])
@pytest.mark.parametrize("dense", [False, True])
def test_global_rank_with_many_rows(spark, partitions, dense):
    df = spark.range(30_000).selectExpr("id", "CASE WHEN id % 97 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE (id * 7919) % 10007 END AS v")
    got = {r["id"]: r["rank"] for r in rank.global_rank(df, "v", dense=dense, partitions=partitions).collect()}
    values = {r["id"]: r["v"] for r in df.collect()}
    place, n, counts = {}, 0, {}
    for v in values.values():
        counts[v] = counts.get(v, 0) + 1
    for v in sorted((v for v in counts if v is not None), reverse=True):
        place[v] = n + 1
        n += 1 if dense else counts[v]
    place[None] = n + 1
    assert got == {i: place[v] for i, v in values.items()}


def test_global_rank_keeps_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, None)], "id int, v int")
    assert sorted((r["id"], r["rank"]) for r in rank.global_rank(df, "v").collect()) == [(1, 1), (1, 1), (2, 3)]
    assert rank.global_rank(df.limit(0), "v").collect() == []


def test_padded_keys_are_never_shortened(spark):
    df = spark.createDataFrame([("7",), ("1234567",), ("123456789",), ("12345678901",), (None,)], "k string")
    assert [r[0] for r in df.select(pad_key("k", 8)).collect()] == ["00000007", "01234567", "123456789", "12345678901", None]


def test_merges_keep_null_keys_and_take_null_values(spark):
    t = spark.createDataFrame([(None, 1, "a"), (1, 5, "b"), (2, 6, "c")], "k int, v int, note string")
    s = spark.createDataFrame([(None, 9), (1, None), (3, 7)], "k int, v int")
    got = {(r["k"], r["v"], r["note"], r["action"]) for r in merge.merge3(t, s, ["k"], ["v"]).collect()}
    assert got == {(None, 9, "a", "update"), (1, None, "b", "update"), (3, 7, None, "insert")}
    got = {(r["k"], r["v"], r["note"]) for r in merge.upsert(t, s, ["k"]).collect()}
    assert got == {(None, 9, "a"), (1, None, "b"), (2, 6, "c"), (3, 7, None)}


def test_missing_values_report_nulls(spark):
    df = spark.createDataFrame([(None, "1"), ("a", None), ("a", "1")], "m string, s string")
    dim = spark.createDataFrame([("a", "1")], "m string, s string")
    got = {r["value"] for r in validate.missing_in(df, ["m", "s"], dim, ["m", "s"], "src", "cat").collect()}
    assert got == {"/1", "a/"}


def test_calendar_covers_the_dates_of_the_data(spark, tmp_path):
    base = "/root/testdata/sf0.001"
    li, o = spark.read.parquet(f"{base}/lineitem.parquet"), spark.read.parquet(f"{base}/orders.parquet")
    kind = li.schema["l_shipdate"].dataType
    far = [li.limit(1).withColumn("l_shipdate", F.lit(d).cast(kind)) for d in ("2004-12-31", "1991-01-01")]
    li.union(far[0]).union(far[1]).write.parquet(str(tmp_path / "lineitem.parquet"))
    o.write.parquet(str(tmp_path / "orders.parquet"))
    m = Model(spark, str(tmp_path))
    assert m.lines.join(m.calendar, m.lines.dim_date_id == m.calendar.id, "left_anti").count() == 0
