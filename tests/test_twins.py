"""Every job with a SQL twin gives the twin's rows on the small tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from quern.sources.tables import TABLES, table_path
from tools.check_twins import compare

TWINS = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{table_path(sf_dir, name)}'")
    return connection


def test_every_twin_belongs_to_a_job():
    assert set(TWINS) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, sf_dir, duck, name):
    result = contract.queries()[name](spark, sf_dir).toArrow()
    assert compare(result, duck.sql(TWINS[name]).to_arrow_table()) == []


def test_entry_has_three_rows(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 3
    averages = [r.avg_rating for r in rows]
    assert averages == sorted(averages, reverse=True)
