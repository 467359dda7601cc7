from datetime import date, datetime
from decimal import Decimal

from conftest import pos, rows, sale

from tillflow.functions.accesslog import parse_access_log
from tillflow.functions.lineage import add_audit, add_lineage
from tillflow.functions.sales import conform_amounts, derive_sales
from tillflow.functions.text import cleanse, standardise
from tillflow.functions.typing import all_text, typed_master, typed_sales


def test_unreadable_text_becomes_null(spark):
    bad = pos(spark, sale(quantity="abc", price="x", discount="", time="2026-13-01"))
    row = typed_sales(bad).first()
    assert (row.quantity, row.unit_price, row.discount_amount, row.transaction_time) == (
        None, None, None, None,
    )
    fraction = typed_sales(pos(spark, sale(quantity="1.5"))).first()
    assert fraction.quantity is None


def test_derivation(spark):
    row = derive_sales(
        typed_sales(pos(spark, sale(quantity="3", price="9.99", discount="1.50")))
    ).first()
    assert row.transaction_date == date(2026, 7, 10)
    assert (row.subtotal, row.net_amount) == (Decimal("29.97"), Decimal("28.47"))
    assert (row.transaction_year, row.transaction_month, row.transaction_day) == (2026, 7, 10)
    assert row.transaction_weekday == 6  # Friday, Sunday being 1
    assert row.year_month == "2026-07"


def test_missing_discount_counts_as_zero(spark):
    row = conform_amounts(derive_sales(typed_sales(pos(spark, sale(discount=None))))).first()
    assert row.sales_amount == Decimal("100.00")
    assert row.discount_amount is None and row.discount_percentage is None


def test_discount_share(spark):
    shares = [
        row.discount_percentage
        for row in conform_amounts(
            derive_sales(
                typed_sales(
                    pos(
                        spark,
                        sale(quantity="3", price="1.00", discount="1.00"),
                        sale(price="0.00", discount="1.00"),
                        sale(price="0.01", discount="999.00"),
                    )
                )
            )
        ).collect()
    ]
    assert shares == [Decimal("33.33"), None, None]


def test_cleansing(spark):
    df = spark.createDataFrame(
        [(" a ", "Ann@X.COM", "090-12-34", 1), ("null", " NULL ", None, 2), ("", "b", "-", 3)],
        "name STRING, email STRING, phone STRING, n INT",
    )
    assert rows(cleanse(df)) == sorted(
        [("a", "ann@x.com", "0901234", 1), (None, None, None, 2), (None, "b", "", 3)], key=repr
    )


def test_standardise_skips_ids_and_other_types(spark):
    df = spark.createDataFrame([("p1", " abc ", 5, "2026-07")], "p_id STRING, s STRING, n INT, m STRING")
    assert rows(standardise(df, skip=["m"])) == [("p1", "ABC", 5, "2026-07")]


def test_log_lines(spark):
    lines = spark.createDataFrame(
        [("t INFO ip=1.2.3.4 user_id=7 page=/a action=view",), ("t ERROR user_id=7",), ("alone",)],
        "value STRING",
    )
    assert rows(parse_access_log(lines)) == sorted(
        [
            ("t", "INFO", "1.2.3.4", "7", "/a", "view"),
            ("t", "ERROR", "", "7", "", ""),
            ("alone", None, "", "", "", ""),
        ],
        key=repr,
    )


def test_old_column_name_is_read(spark):
    df = spark.createDataFrame([("c", "n", "top")], "category_id STRING, category_name STRING, parent_category STRING")
    assert typed_master(df, "category_master").first().parent_category_id == "top"


def test_all_text(spark):
    df = spark.createDataFrame([(1, 2.5, True, date(2026, 7, 10))], "a INT, b DOUBLE, c BOOLEAN, d DATE")
    assert rows(all_text(df)) == [("1", "2.5", "true", "2026-07-10")]


def test_run_columns(spark):
    at = datetime(2026, 7, 10, 3)
    df = spark.createDataFrame([("f",)], "_source_file STRING")
    landed = add_lineage(df, "b1", "2026-07-10", at)
    assert landed.columns == ["_source_file", "_ingestion_timestamp", "_job_date", "_batch_id"]
    assert add_lineage(df, "b1").columns == ["_source_file", "_ingestion_timestamp", "_batch_id"]
    row = add_audit(df, "b1", "2026-07-10", "tills", at).first()
    assert (row.batch_id, row.job_date, row.source_system) == ("b1", "2026-07-10", "tills")
    assert row.processed_timestamp == at
