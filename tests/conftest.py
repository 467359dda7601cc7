from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillflow.session import session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    built = session(
        "tillflow-tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df):
    """Rows as tuples in a fixed order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


POS = (
    "transaction_id STRING, customer_id STRING, product_id STRING, store_id STRING,"
    " quantity STRING, unit_price STRING, discount_amount STRING, transaction_time STRING"
)


def pos(spark, *lines):
    return spark.createDataFrame(list(lines), POS)


def sale(
    id="t1", customer="c1", product="p1", store="s1", quantity="1", price="100.00",
    discount="0.00", time="2026-07-10 10:00:00",
):
    return (id, customer, product, store, quantity, price, discount, time)
