"""Every registered query vs its DuckDB oracle on the sf0.001 tables, floats bit for bit."""

import duckdb
import pytest

from hearth.plans import registry
from hearth.sources.tables import DRIVER_TABLES
from tests.conftest import SF001
from tests.oracle_check import canon, oracle_rows

NAMES = list(registry.load_all())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = registry.build(name, spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    sql = registry.oracle(name)
    if sql is None:
        assert len(df.columns) > 0
        return
    ocols, orows = oracle_rows(con, sql)
    a, ac = canon(df.columns, rows, exact=True)
    b, bc = canon(ocols, orows, exact=True)
    assert ac == bc
    assert len(a) == len(b)
    assert a == b


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


# Spark simple type name -> DuckDB type name (DECIMAL(p,s) maps by upper case).
DUCKDB_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
               "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", [n for n in NAMES if registry.oracle(n) is not None])
def test_query_types_match_oracle(spark, con, name):
    df = registry.build(name, spark, SF001)
    rel = con.sql(registry.oracle(name))
    oracle_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert DUCKDB_TYPE.get(t, t.upper()) == oracle_types.get(f.name), (f.name, t)
