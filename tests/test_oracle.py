"""Every registered query against the same question in DuckDB."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()
# Spark type names as DuckDB prints them; others differ only in case.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_of_the_retail_tables_has_an_oracle():
    assert entry_point.QUERIES.keys() == entry_point.ORACLE.keys()
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    result = entry_point.queries()[name](spark, sf_dir)
    names = sorted(result.columns)
    sql = entry_point.oracle_sql()[name]

    spark_types = {
        f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        for f in result.schema.fields
    }
    described = duck.execute(f"DESCRIBE {sql}").fetchall()
    assert spark_types == {row[0]: str(row[1]) for row in described}

    columns = ", ".join(f'"{c}"' for c in names)
    expected = duck.execute(f"SELECT {columns} FROM ({sql})").fetchall()
    actual = [tuple(row) for row in result.select(*[f"`{c}`" for c in names]).collect()]
    assert Counter(map(repr, actual)) == Counter(map(repr, expected))
    assert actual


def test_entry_runs(spark):
    result = entry_point.entry(spark)
    assert "total_sales" in result.columns
    assert result.count() > 0
