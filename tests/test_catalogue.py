"""Every catalogue query against its DuckDB oracle at sf0.01, as the driver checks it."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import compare, duck  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from lineflow.catalogue import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    _, n, m, status, _ = compare(spark, con, name, SF)
    assert status == "ok", status


def test_entry(spark):
    df = entry(spark)
    assert df.dtypes == [("event_id", "bigint"), ("topic", "string"), ("value", "string")]
    rows = df.collect()
    assert rows and all(r.topic in ("clean", "errors") for r in rows)
