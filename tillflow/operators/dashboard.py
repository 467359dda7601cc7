"""What each dashboard tile reads from the gold tables.

The counters keep the tiles' own definitions, which differ from what their
titles suggest: see the docstrings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators.gold import ranked, top


def total_revenue(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("total_sales").alias("total_sales"))


def total_transactions(daily: DataFrame) -> DataFrame:
    """Sum of daily counts: an id seen on two days counts twice."""
    return daily.agg(F.sum("transaction_count").alias("transaction_count"))


def unique_customers(daily: DataFrame) -> DataFrame:
    """Customers on the busiest day, not distinct customers overall."""
    return daily.agg(F.max("unique_customers").alias("unique_customers"))


def average_transaction(daily: DataFrame) -> DataFrame:
    """Mean of the daily means, not weighted by the number of sales."""
    return daily.agg(F.avg("avg_transaction_value").alias("avg_transaction_value"))


def category_comparison(daily: DataFrame) -> DataFrame:
    """A single total, though the tile's title speaks of categories."""
    return total_revenue(daily)


def daily_trend(daily: DataFrame) -> DataFrame:
    return daily.select("transaction_date", "total_sales").orderBy("transaction_date")


def top_products(products: DataFrame, rows: int = 10) -> DataFrame:
    return top(products, "total_revenue", "product_id", "product_name", rows=rows)


def top_customers(customers: DataFrame, rows: int = 10) -> DataFrame:
    return top(customers, "lifetime_value", "customer_id", rows=rows)


def top_product_bars(products: DataFrame) -> DataFrame:
    return top_products(products).select("product_name", "total_revenue")


def category_performance(categories: DataFrame) -> DataFrame:
    return ranked(categories, "revenue_share_pct", "category_id")


def category_revenue(categories: DataFrame) -> DataFrame:
    return category_performance(categories).select("category_id", "total_revenue")


def category_share(categories: DataFrame) -> DataFrame:
    return category_performance(categories).select(
        "category_id", "total_revenue", "revenue_share_pct"
    )


def top_customer_list(customers: DataFrame) -> DataFrame:
    return top_customers(customers).select(
        "customer_id", "total_transactions", "lifetime_value",
        "avg_transaction_value", "last_purchase_date", "customer_tenure_days",
    )


def customer_table(customers: DataFrame) -> DataFrame:
    return top_customers(customers).orderBy("customer_id")


def revenue_per_transaction_by_category(products: DataFrame) -> DataFrame:
    """Over the ten best products only."""
    return top_products(products).groupBy("category_id").agg(
        F.sum("avg_revenue_per_transaction").alias("avg_revenue_per_transaction")
    )


def top_revenue_by_category(products: DataFrame) -> DataFrame:
    """Over the ten best products only."""
    return top_products(products).groupBy("category_id").agg(
        F.sum("total_revenue").alias("total_revenue")
    )


def cross_filter(df: DataFrame, selection: Mapping[str, Sequence]) -> DataFrame:
    """Rows equal to the selected values; a selected None matches missing ones."""
    for name, values in selection.items():
        known = [value for value in values if value is not None]
        match = F.col(name).isin(known) if known else F.lit(False)
        if len(known) < len(values):
            match = match | F.col(name).isNull()
        df = df.where(match)
    return df
