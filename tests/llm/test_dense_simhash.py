"""SimHash links of dense cells, by rows and by blocks, against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermaster.llm import simhash
from quartermaster.llm.common import prepare


def brute(prints, most):
    u = np.array(sorted({p for _, p in prints}), np.int64)
    near = np.bitwise_count(u.view(np.uint64)[:, None] ^ u.view(np.uint64)) <= most
    label = np.arange(len(u))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    ids = {}
    for i, p in prints:
        ids.setdefault(int(p), []).append(i)
    parts = {}
    for p, root in zip(u.tolist(), label.tolist()):
        parts.setdefault(root, []).extend(ids[p])
    return {p: (min(parts[root]), int(n) - 1) for p, root, n in zip(u.tolist(), label.tolist(), near.sum(axis=1))}


@pytest.mark.parametrize("most", [0, 1, 2, 4, 6])
@pytest.mark.parametrize("dense, block", [(2, 5), (1 << 40, 2048)])
def test_dense_groups_equal_all_pairs(spark, monkeypatch, most, dense, block):
    monkeypatch.setattr(simhash, "DENSE_CELL", dense)
    monkeypatch.setattr(simhash, "BLOCK_PRINTS", block)
    prepare(spark)
    rng = np.random.default_rng(most)
    prints = []
    for centre in rng.integers(-(1 << 63), 1 << 63, 4):
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            fp = int(centre) & (1 << 64) - 1
            for f in flips.tolist():
                fp ^= 1 << f
            prints.append((len(prints), simhash.signed(fp)))
    prints += [(1000, 0), (1001, 0), (1002, -1), (1003, 15)]
    df = spark.createDataFrame(prints, "doc_id long, fp long")
    got = {r["fp"]: (r["component_id"], r["links"]) for r in simhash.components(df, most).collect()}
    assert got == brute(prints, most)


def test_grids_are_numbered_in_order(spark):
    prepare(spark)
    for most in (1, 3):
        masks = simhash.block_masks(most)
        rows = [(x,) for x in range(1 << 2 * most)]  # bit i: block i differs
        df = spark.createDataFrame(rows, "d long")
        b = sum((F.when(F.col("d").bitwiseAND(F.lit(1 << i)) != 0, F.lit(masks[i])).otherwise(0) for i in range(2 * most)), F.lit(0))
        for r in df.select("d", simhash.first_grid(F.lit(0).cast("long"), b, most).alias("g")).collect():
            agree = [i for i in range(2 * most) if not r.d >> i & 1]
            if len(agree) >= most:
                assert list(simhash.combinations(range(2 * most), most))[r.g] == tuple(agree[:most])


def test_keep_one_keeps_a_column_of_its_own_name(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, "a b c d", "keep"), (2, "a b c d", "also")], "doc_id long, text string, _simhash_row string")
    assert [tuple(r) for r in simhash.keep_one(df).collect()] == [(1, "a b c d", "keep")]
