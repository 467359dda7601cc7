"""Columns computed from one sale."""

from __future__ import annotations

from pyspark.sql import DataFrame

DERIVED = (
    "to_date(transaction_time) AS transaction_date",
    "quantity * unit_price AS subtotal",
    "quantity * unit_price - coalesce(discount_amount, CAST(0 AS DECIMAL(10,2))) AS net_amount",
    "year(transaction_time) AS transaction_year",
    "month(transaction_time) AS transaction_month",
    "dayofmonth(transaction_time) AS transaction_day",
    "dayofweek(transaction_time) AS transaction_weekday",
    "date_format(transaction_time, 'yyyy-MM') AS year_month",
)

MONEY = {
    "amount": "try_cast(subtotal AS DECIMAL(18,2))",
    "sales_amount": "try_cast(net_amount AS DECIMAL(18,2))",
    "discount_percentage": (
        "try_cast(try_divide(discount_amount * 100, subtotal) AS DECIMAL(5,2))"
    ),
    "unit_price": "CAST(unit_price AS DECIMAL(18,2))",
    "discount_amount": "CAST(discount_amount AS DECIMAL(18,2))",
}


def derive_sales(sales: DataFrame) -> DataFrame:
    """Date, date parts and money of each sale.

    A sale without a discount counts as discounted by 0 in ``net_amount``.
    """
    return sales.selectExpr("*", *DERIVED)


def conform_amounts(sales: DataFrame) -> DataFrame:
    """The money columns under the names and types the fact table carries.

    ``amount`` is before discount and ``sales_amount`` after it. A share of a
    zero amount, or one too large for its column, is NULL.
    """
    replaced = {"subtotal", "net_amount", *MONEY}
    kept = [name for name in sales.columns if name not in replaced]
    return sales.selectExpr(*kept, *[f"{value} AS {name}" for name, value in MONEY.items()])
