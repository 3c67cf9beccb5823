"""Every registered query beside its SQL twin on the smallest tables."""

import duckdb
import pytest

from check import TABLES, canonical
from subjectlog.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in ORACLES:
        assert df.columns
        return
    columns = [r[0] for r in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()]
    assert sorted(df.columns) == sorted(columns)
    want = con.execute(ORACLES[name]).fetchall()
    assert canonical(df.columns, rows) == canonical(columns, want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
