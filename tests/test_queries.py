"""Every registered query at the smallest scale, against its SQL in DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from lakemart.checks import all_queries, all_sql
from lakemart.checks.star import STARS

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    return value


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(comparable(r[i]) for i in order) for r in records),
        key=lambda r: [(v is None, str(type(v)), str(v)) for v in r],
    )


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    got = QUERIES[name](spark, SF_DIR)
    cursor = db.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, cursor.fetchall())


def test_vetting_links_every_line(spark, db):
    """All lines are risk links, most parts have several risks, and some have none."""
    links = STARS["fact_vetting"].dims["dim_lpd_loivettingrisk"].frame(spark, SF_DIR)
    assert links.count() == db.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    sets = [r[0] for r in QUERIES["fact_vetting"](spark, SF_DIR).select("vettingrisk_sks").collect()]
    unknown = sum(x == "0" for x in sets)
    assert 0 < unknown < len(sets) / 10
    assert sum("," in x for x in sets) > len(sets) / 2


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "order_fact_id"
    assert df.count() == 1500
