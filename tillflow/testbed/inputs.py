"""The retail inputs built from the star-schema test tables.

Everything is derived row by row from whole tables and rendered as text, as the
raw feeds would hold it. ``flawed`` inputs carry faults set by column values,
so every rule of the library has rows to find.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sales after this moment count as future ones in the flawed sales.
AS_OF = datetime(2001, 8, 1)


# Stated so that opening a table reads no file.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
        " p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
        " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
        " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
        " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,"
        " props STRING"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _texts(df: DataFrame, **columns: str) -> DataFrame:
    """The named SQL expressions, each as text."""
    return df.selectExpr(*[f"CAST({e} AS STRING) AS {name}" for name, e in columns.items()])


def _sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the customer of their order and the price of their part."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS l_orderkey", "o_custkey", "o_orderpriority"
    )
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS l_partkey", "CAST(p_retailprice AS DECIMAL(10,2)) AS price"
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, "l_partkey")
        .join(orders, "l_orderkey")
        .selectExpr(
            "*",
            "l_orderkey || '-' || l_linenumber AS line_id",
            "CAST(l_quantity AS INT) AS units",
            "CAST(l_discount AS DECIMAL(4,2)) AS rate",
            "CAST(l_tax AS DECIMAL(4,2)) AS tax",
        )
    )


DISCOUNT = "CAST(units * price * rate AS DECIMAL(10,2))"


def pos_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean sales; a line's order and number make the transaction id."""
    return _texts(
        _sale_lines(spark, sf_dir),
        transaction_id="line_id",
        customer_id="o_custkey",
        product_id="l_partkey",
        store_id="l_suppkey",
        quantity="units",
        unit_price="price",
        discount_amount=DISCOUNT,
        transaction_time="l_shipdate",
    )


def flawed_pos_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with guests, missing, wrong, unreadable and future values.

    Low-priority orders are guests: a fifth of all rows without a customer.
    """

    def where(rate: str, tax: str, value: str) -> str:
        return f"WHEN tax = {tax} AND rate = {rate} THEN {value}"

    def otherwise(value: str) -> str:
        return f"ELSE CAST({value} AS STRING) END"

    return _texts(
        _sale_lines(spark, sf_dir),
        transaction_id=f"CASE {where('0.10', '0.08', 'NULL')} {where('0.09', '0.08', repr('  '))} {otherwise('line_id')}",
        customer_id=(
            "CASE WHEN o_orderpriority = '5-LOW' THEN NULL"
            f" {where('0.10', '0.01', repr(' null '))} {where('0.09', '0.01', repr(' '))} ELSE o_custkey || ' ' END"
        ),
        product_id=f"CASE {where('0.10', '0.07', repr('Null'))} {where('0.09', '0.07', repr(''))} {otherwise('l_partkey')}",
        store_id=f"CASE {where('0.10', '0.02', 'NULL')} {where('0.09', '0.02', repr(' '))} {otherwise('l_suppkey')}",
        quantity=(
            f"CASE {where('0.10', '0.06', repr('0'))} {where('0.09', '0.06', repr('-1'))}"
            f" {where('0.10', '0.05', repr('abc'))} {where('0.09', '0.05', 'NULL')}"
            f" {where('0.08', '0.06', repr(' '))}"
            f" {otherwise('units')}"
        ),
        unit_price=(
            f"CASE {where('0.10', '0.04', repr('-0.01'))} {where('0.09', '0.04', repr('0.00'))}"
            f" {where('0.08', '0.04', repr(''))}"
            f" {otherwise('price')}"
        ),
        discount_amount=f"CASE WHEN rate = 0.00 THEN NULL {otherwise(DISCOUNT)}",
        transaction_time=(
            f"CASE {where('0.10', '0.03', repr('2026-13-01'))} {where('0.09', '0.03', 'NULL')}"
            f" {where('0.08', '0.03', repr('  '))}"
            f" {otherwise('l_shipdate')}"
        ),
    )


def product_master(spark: SparkSession, sf_dir: str, but_brand: str | None = None) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    if but_brand:
        parts = parts.where(F.col("p_brand") != but_brand)
    return _texts(
        parts,
        product_id="p_partkey",
        product_name="p_name",
        category_id="p_type",
        unit_price="CAST(p_retailprice AS DECIMAL(10,2))",
        cost_price="NULL",
        supplier_id="p_brand",
    )


def category_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(
        table(spark, sf_dir, "part").select("p_type").distinct(),
        category_id="p_type",
        category_name="'Category ' || lower(p_type)",
        parent_category_id="'ALL'",
        category_level="1",
    )


def customer_master(
    spark: SparkSession, sf_dir: str, but_segment: str | None = None
) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    if but_segment:
        customers = customers.where(F.col("c_mktsegment") != but_segment)
    return _texts(
        customers,
        customer_id="c_custkey",
        customer_name="' ' || c_name || ' '",
        email="c_name || '@Example.COM'",
        phone="'090-' || c_nationkey || '-' || c_custkey",
        birth_date=(
            "CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE (1950 + c_nationkey) || '-01-15' END"
        ),
        gender="CASE WHEN c_acctbal < 0 THEN 'NULL' ELSE 'f' END",
        registration_date="'1994-12-31'",
    )


def store_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers, nations, regions = (
        table(spark, sf_dir, name) for name in ("supplier", "nation", "region")
    )
    return _texts(
        suppliers.join(nations, F.expr("s_nationkey = n_nationkey")).join(
            regions, F.expr("n_regionkey = r_regionkey")
        ),
        store_id="s_suppkey",
        store_name="s_name",
        region="r_name",
        open_date="CASE WHEN s_acctbal < 0 THEN 'unknown' ELSE '1990-06-01' END",
        store_type="'street'",
        manager_name="NULL",
    )


def store_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with one row per store, to size the store master by."""
    return table(spark, sf_dir, "supplier")


def retail_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order date; ship dates run past the last of them."""
    return _texts(
        table(spark, sf_dir, "orders").selectExpr("to_date(o_orderdate) AS d").distinct(),
        date="d",
        year="year(d)",
        month="month(d)",
        day="day(d)",
        day_of_week="dayofweek(d)",
        fiscal_year="CASE WHEN month(d) < 4 THEN year(d) - 1 ELSE year(d) END",
        fiscal_quarter="quarter(add_months(d, -3))",
        is_retail_peak="month(d) >= 11",
    )


def holiday_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates on the first of January and May, and on the days around Christmas."""
    return _texts(
        table(spark, sf_dir, "orders").selectExpr("to_date(o_orderdate) AS d").distinct().where(
            "date_format(d, 'MM-dd') IN ('01-01', '05-01', '12-25', '12-26')"),
        date="d",
        holiday_name="'Holiday ' || date_format(d, 'MM-dd')",
        holiday_type="'public'",
        country="'XX'",
    )


def inventory_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed stock per product and store."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey AS product_id", "l_suppkey AS store_id",
        "CAST(l_quantity AS BIGINT) AS units", "to_date(l_shipdate) AS shipped",
    )
    return lines.groupBy("product_id", "store_id").agg(
        F.sum("units").alias("quantity_on_hand"),
        F.count("*").alias("quantity_reserved"),
        F.max("shipped").alias("last_updated"),
    )


def online_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with real numbers, as the JSON extract writes them."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return table(spark, sf_dir, "lineitem").join(orders, "l_orderkey").selectExpr(
        "l_orderkey AS order_id",
        "o_custkey AS customer_id",
        "l_partkey AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS price",
        "CAST(l_discount AS DECIMAL(4,2)) AS discount",
        "to_date(o_orderdate) AS order_timestamp",
        "o_orderpriority AS payment_method",
        "CAST(NULL AS STRING) AS shipping_address",
    )


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines: errors have no page, sign-ups only a timestamp."""
    who = "' ip=10.0.0.' || user_id || ' user_id=' || user_id"
    events = table(spark, sf_dir, "events").selectExpr(
        "event_type", f"{who} AS who",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") AS stamp",
    )
    return _texts(
        events,
        value=(
            "CASE WHEN event_type = 'signup' THEN stamp"
            " WHEN event_type = 'error' THEN stamp || ' ERROR' || who || ' action=error'"
            " ELSE stamp || ' INFO' || who || ' page=/shop/' || event_type"
            " || ' action=' || event_type END"
        ),
    )


def clean_masters(
    spark: SparkSession, sf_dir: str, needed: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """The masters needed; all if that is not said."""
    masters = {
        "product_master": product_master,
        "category_master": category_master,
        "customer_master": customer_master,
        "store_master": store_master,
        "retail_calendar": retail_calendar,
    }
    return {name: masters[name](spark, sf_dir) for name in (masters if needed is None else needed)}


def flawed_masters(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Masters that lack one brand, one market segment, one region and one category."""
    return {
        "product_master": product_master(spark, sf_dir, but_brand="Brand#7"),
        "category_master": category_master(spark, sf_dir).where("category_id <> 'PROMO'"),
        "customer_master": customer_master(spark, sf_dir, but_segment="MACHINERY"),
        "store_master": store_master(spark, sf_dir).where("region <> 'ASIA'"),
        "retail_calendar": retail_calendar(spark, sf_dir),
    }
