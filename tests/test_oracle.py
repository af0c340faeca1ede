"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from eventflow.plans import ORACLE, QUERIES
from tools.check_oracle import check

SF = os.environ.get("EVENTFLOW_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = check(spark, SF, [name], verbose=False)[name]
    assert res[0] in ("OK", "ROWS"), res


def test_every_query_is_registered_and_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["window_start", "window_end", "n"] and len(rows) == 1
