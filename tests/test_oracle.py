"""Every registered query against its DuckDB oracle (sf0.001 here; the
driver and tools/oracle_check.py run the same comparison at sf0.01)."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import TABLES, compare  # noqa: E402

ORACLES = entry._reference_oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry._reference_queries()))
def test_query_matches_oracle(spark, con, name):
    msg = compare(spark, con, name, entry.queries()[name], ORACLES.get(name), SF001)
    assert msg.split("\n")[0].split(": ")[1].startswith("OK"), msg


def test_every_query_has_an_oracle():
    assert set(entry._reference_queries()) == set(ORACLES)
