"""Every registered query with SQL against it, on the smallest tables; the others have tests of their own."""

import duckdb
import pytest

import __spark_entry__ as registry
from tests.conftest import SF_DIR

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, repr(x)) for x in r])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == columns
    expected = duck.sql("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({SQL[name]})").fetchall()
    assert _sorted(rows) == _sorted(expected)
    assert rows


def test_entry_runs(spark):
    df = registry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["point_id", "shard", "vec_dim", "vec_sum", "vec_id", "label"]
