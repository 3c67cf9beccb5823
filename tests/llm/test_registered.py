"""Registered queries with SQL twins, on the smallest tables."""

import duckdb
import pytest
from check import TABLES, canonical

from subjectlog.llm.queries import ORACLES, QUERIES


def test_all_are_registered():
    import __spark_entry__

    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    columns = [r[0] for r in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()]
    assert canonical(df.columns, df.collect()) == canonical(columns, con.execute(ORACLES[name]).fetchall())
