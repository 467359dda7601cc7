"""Column contracts of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# The business columns of the thirteen raw feeds, in file order.
# Everything lands as text.
FEED_COLUMNS = {
    "pos_transactions": [
        "transaction_id", "customer_id", "product_id", "store_id", "quantity", "unit_price",
        "discount_amount", "transaction_time",
    ],
    "online_orders": [
        "order_id", "customer_id", "product_id", "quantity", "price", "discount",
        "order_timestamp", "payment_method", "shipping_address",
    ],
    "web_clickstream": ["timestamp", "level", "ip", "user_id", "page", "action"],
    "customer_master": [
        "customer_id", "customer_name", "email", "phone", "birth_date", "gender",
        "registration_date",
    ],
    "loyalty_members": [
        "customer_id", "membership_tier", "points_balance", "join_date", "expiry_date",
    ],
    "coupon_dispatches": [
        "coupon_id", "customer_id", "coupon_code", "discount_type", "discount_value",
        "dispatch_date", "expiry_date", "status",
    ],
    "product_master": [
        "product_id", "product_name", "category_id", "unit_price", "cost_price", "supplier_id",
    ],
    "category_master": ["category_id", "category_name", "parent_category_id", "category_level"],
    "supplier_master": [
        "supplier_id", "supplier_name", "contact_person", "phone", "email", "address",
    ],
    "store_master": [
        "store_id", "store_name", "region", "open_date", "store_type", "manager_name",
    ],
    "inventory_balance": [
        "product_id", "store_id", "quantity_on_hand", "quantity_reserved", "last_updated",
    ],
    "retail_calendar": [
        "date", "year", "month", "day", "day_of_week", "fiscal_year", "fiscal_quarter",
        "is_retail_peak",
    ],
    "holiday_calendar": ["date", "holiday_name", "holiday_type", "country"],
}

# The older column names some extracts still carry.
COLUMN_ALIASES = {
    "category_master": {"parent_category": "parent_category_id"},
}

# Types of the columns that silver reads from bronze.
SALES_TYPES = {
    "transaction_id": "string",
    "customer_id": "string",
    "product_id": "string",
    "store_id": "string",
    "quantity": "int",
    "unit_price": "decimal(10,2)",
    "discount_amount": "decimal(10,2)",
    "transaction_time": "timestamp",
}
MASTER_TYPES = {
    "product_master": {
        "product_id": "string",
        "product_name": "string",
        "category_id": "string",
        "unit_price": "decimal(18,2)",
    },
    "category_master": {
        "category_id": "string",
        "category_name": "string",
        "parent_category_id": "string",
    },
    "customer_master": {
        "customer_id": "string",
        "customer_name": "string",
        "email": "string",
        "phone": "string",
        "birth_date": "date",
        "gender": "string",
    },
    "store_master": {
        "store_id": "string",
        "store_name": "string",
        "region": "string",
        "open_date": "date",
    },
    "retail_calendar": {
        "date": "date",
        "year": "int",
        "month": "int",
        "day": "int",
        "day_of_week": "string",
        "fiscal_year": "int",
        "is_retail_peak": "boolean",
    },
}
MASTER_KEYS = {
    "product_master": "product_id",
    "category_master": "category_id",
    "customer_master": "customer_id",
    "store_master": "store_id",
    "retail_calendar": "date",
}

# What a row holds beyond the contract: the whole text of a row that does not fit
# it, and, as a JSON map, the fields of a JSON line that it does not name.
CORRUPT = "_corrupt_record"
EXTRA = "_extra_fields"
BEYOND = {"csv": [CORRUPT], "json": [CORRUPT, EXTRA]}

TEXTS = T.ArrayType(T.StringType())


def feed_schema(feed: str) -> T.StructType:
    """The file schema of one feed: text only."""
    return T.StructType([T.StructField(c, T.StringType()) for c in FEED_COLUMNS[feed]])


def bronze_schema(feed: str, dated: bool, kind: str = "") -> T.StructType:
    """The table schema of one feed. Dated feeds end in their partition columns."""
    schema = feed_schema(feed)
    for name in BEYOND.get(kind, []):
        schema.add(name, "string")
    schema.add("_ingestion_timestamp", "timestamp").add("_source_file", "string")
    if dated:
        schema.add("_job_date", "string")
    return schema.add("_batch_id", "string")


# The published columns of the sales fact and the run tables.
FACT_SALES = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("transaction_time", T.TimestampType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("store_name", T.StringType()),
        T.StructField("store_region", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(18, 2)),
        T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("discount_amount", T.DecimalType(18, 2)),
        T.StructField("discount_percentage", T.DecimalType(5, 2)),
        T.StructField("sales_amount", T.DecimalType(18, 2)),
        T.StructField("transaction_year", T.IntegerType()),
        T.StructField("transaction_month", T.IntegerType()),
        T.StructField("transaction_day", T.IntegerType()),
        T.StructField("transaction_weekday", T.IntegerType()),
        T.StructField("year_month", T.StringType()),
        T.StructField("fiscal_year", T.IntegerType()),
        T.StructField("is_retail_peak", T.BooleanType()),
        T.StructField("missing_masters", TEXTS),
        T.StructField("batch_id", T.StringType()),
        T.StructField("processed_timestamp", T.TimestampType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("job_date", T.StringType()),
    ]
)

REJECT_SALES = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("raw_data", T.StringType()),
        T.StructField("rejection_reason", T.StringType()),
        T.StructField("rejection_category", T.StringType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("reasons", TEXTS),
        T.StructField("source_file", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("rejected_timestamp", T.TimestampType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("job_date", T.StringType()),
    ]
)

# Which bits of an id filter are set, 32,768 of them a row.
SALE_ID_FILTERS = T.StructType(
    [
        T.StructField("bucket", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField("job_date", T.StringType()),
    ]
)

# Keys of a day's sales that no master knew.
MISSING_KEYS = T.StructType(
    [
        T.StructField("sale_column", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("job_date", T.StringType()),
    ]
)

# Sales accepted from a stream, before the day's run.
LIVE_SALES = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("discount_amount", T.DecimalType(10, 2)),
        T.StructField("transaction_time", T.TimestampType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_job_date", T.StringType()),
        T.StructField("micro_batch", T.LongType()),
    ]
)

# Customers and products by number, in the partition of the day that first sold to or of them.
MEMBER_NUMBERS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("job_date", T.StringType()),
    ]
)

# The days whose states the gold totals hold.
MERGED_DAYS = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("job_date", T.StringType()),
    ]
)

JOB_LOG = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("job_date", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("start_timestamp", T.TimestampType()),
        T.StructField("end_timestamp", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("records_read", T.LongType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("records_rejected", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("execution_duration_seconds", T.DoubleType()),
    ]
)

# The published metric and key columns of the four gold tables, which
# the dashboard reads.
DAILY_SALES = T.StructType(
    [
        T.StructField("transaction_date", T.DateType()),
        T.StructField("transaction_count", T.LongType()),
        T.StructField("total_quantity", T.LongType()),
        T.StructField("total_sales", T.DecimalType(28, 2)),
        T.StructField("total_discount", T.DecimalType(28, 2)),
        T.StructField("avg_transaction_value", T.DecimalType(22, 6)),
        T.StructField("avg_items_per_transaction", T.DoubleType()),
        T.StructField("avg_discount_rate", T.DecimalType(9, 6)),
        T.StructField("unique_customers", T.LongType()),
        T.StructField("unique_products_sold", T.LongType()),
    ]
)

CUSTOMER_METRICS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("total_transactions", T.LongType()),
        T.StructField("purchase_days", T.LongType()),
        T.StructField("lifetime_value", T.DecimalType(28, 2)),
        T.StructField("avg_transaction_value", T.DecimalType(22, 6)),
        T.StructField("total_items_purchased", T.LongType()),
        T.StructField("unique_products_purchased", T.LongType()),
        T.StructField("first_purchase_date", T.DateType()),
        T.StructField("last_purchase_date", T.DateType()),
        T.StructField("customer_tenure_days", T.IntegerType()),
        T.StructField("purchase_frequency", T.DoubleType()),
    ]
)

PRODUCT_METRICS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("total_units_sold", T.LongType()),
        T.StructField("times_purchased", T.LongType()),
        T.StructField("total_revenue", T.DecimalType(28, 2)),
        T.StructField("avg_unit_price", T.DecimalType(22, 6)),
        T.StructField("unique_customers", T.LongType()),
        T.StructField("first_sale_date", T.DateType()),
        T.StructField("last_sale_date", T.DateType()),
        T.StructField("avg_revenue_per_transaction", T.DecimalType(38, 12)),
    ]
)

CATEGORY_METRICS = T.StructType(
    [
        T.StructField("category_id", T.StringType()),
        T.StructField("total_units_sold", T.LongType()),
        T.StructField("products_in_category", T.LongType()),
        T.StructField("transactions", T.LongType()),
        T.StructField("total_revenue", T.DecimalType(28, 2)),
        T.StructField("avg_transaction_value", T.DecimalType(22, 6)),
        T.StructField("unique_customers", T.LongType()),
        T.StructField("revenue_per_product", T.DecimalType(38, 12)),
        T.StructField("revenue_share_pct", T.DecimalType(5, 2)),
    ]
)
