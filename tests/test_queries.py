"""Every core query with SQL against DuckDB on the same tables, at the smallest scale."""

import duckdb
import pytest

from loomsift import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    tidy = lambda v: round(v, 5) if isinstance(v, float) else v
    return sorted((tuple(tidy(r[k]) for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_duckdb(spark, sf_dir, duck, name):
    found = queries.QUERIES[name](spark, sf_dir)
    want = duck.sql(queries.ORACLES[name])
    assert sorted(found.columns) == sorted(want.columns)
    assert rows_of(found.columns, [tuple(r) for r in found.collect()]) == rows_of(want.columns, want.fetchall())
