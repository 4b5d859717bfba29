import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tillroll.session import build_session, checkpoint_dir  # noqa: E402
from tillroll.sources.exports import typed_order_lines  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="tillroll-tests", shuffle_partitions=4,
                      conf={"spark.driver.memory": "4g"})
    checkpoint_dir(s, allow_local_default=True)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tillroll-test-")


ORDER_COLS = ["order_id", "email", "status", "created_at", "qty", "product", "price", "sku"]


def order_lines(spark, rows):
    """rows: tuples (order_id, email, status, created_at, qty, product, price, sku);
    created_at may be a bare date (midnight is appended)."""
    norm = []
    for r in rows:
        r = list(r)
        if len(r[3]) == 10:
            r[3] = r[3] + " 00:00:00 -0500"
        norm.append(tuple(None if v is None else str(v) for v in r))
    df = spark.createDataFrame(norm, ", ".join(f"{c} string" for c in ORDER_COLS))
    return typed_order_lines(df)


def line(order_id, product="P", created="2015-01-01", email="a@x", status="fulfilled",
         qty=1, price="1.00", sku="S"):
    return (order_id, email, status, created, qty, product, price, sku)


def rows_of(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def report_df(spark, lines, name="r.csv"):
    return spark.createDataFrame([(name, i, text) for i, text in enumerate(lines)],
                                 "file string, line_no long, line string")


__all__ = ["F", "order_lines", "line", "rows_of", "report_df"]
