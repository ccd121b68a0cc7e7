"""The driver contract: entry() is stable, names line up with the oracle."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001


def test_entry_schema_is_stable(spark):
    a, b = entry.entry(spark), entry.entry(spark)
    assert a.schema == b.schema
    assert a.count() == 25


@pytest.mark.parametrize("name", ["region_kpi_strict", "region_kpi_loose", "top_n_by_total", "top_n_per_measure"])
def test_column_names_and_types_match_oracle(spark, name):
    df = entry.queries()[name](spark, SF001)
    con = duckdb.connect()
    for t in ("events", "nation", "region", "customer", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    rel = con.execute(f"SELECT * FROM ({entry.oracle_sql()[name]}) LIMIT 0")
    oracle = {d[0]: d[1] for d in rel.description}
    assert sorted(df.columns) == sorted(oracle)
    assert len(set(df.columns)) == len(df.columns)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    for col, dtype in df.dtypes:
        if dtype in kinds:
            assert str(oracle[col]).upper() == kinds[dtype], (col, dtype, oracle[col])
