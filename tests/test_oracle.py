"""Every registered query against its SQL twin on DuckDB (sf0.001), as the driver does at sf0.01."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare, duck  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from conftest import SF  # noqa: E402

FAST = [n for n in queries() if n in oracle_sql()]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql_twin(spark, con, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    msg = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert msg is None, msg
