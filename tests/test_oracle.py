"""Every named query against its DuckDB oracle on the smallest test data."""

import pytest

import __spark_entry__ as entry
from checks.compare import digest, duck
from tillroll import catalog

SF = "/root/testdata/sf0.001"
SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(rows) == len(d_rows)
    assert digest(df.columns, rows) == digest(d_cols, d_rows)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    rel = con.sql(entry.oracle_sql()[name])
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["product_1", "product_2", "n_orders"]
    assert df.count() >= 0


ANSI_SENSITIVE = ["customer_profile", "product_week_revenue", "product_growth_report",
                  "csv_order_lines", "daily_sales_summary", "unfulfilled_by_month", "calendar_columns"]


@pytest.fixture
def ansi_off(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.mark.parametrize("name", ANSI_SENSITIVE)
def test_query_matches_oracle_without_ansi(spark, con, ansi_off, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    assert digest(df.columns, rows) == digest(d_cols, cur.fetchall())
