"""Names of the tables of one lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tillflow import schemas as S
from tillflow.operators.partials import STATES
from tillflow.sinks.tables import COMPACT, create_layer, create_table
from tillflow.sources.feeds import FEEDS

GOLD_TABLES = {
    "daily_sales_summary": S.DAILY_SALES,
    "customer_metrics": S.CUSTOMER_METRICS,
    "product_metrics": S.PRODUCT_METRICS,
    "category_metrics": S.CATEGORY_METRICS,
}


@dataclass(frozen=True)
class Lake:
    """Layers are the databases ``<prefix>bronze``, ``silver``, ``gold``, ``audit``."""

    prefix: str = ""

    def bronze(self, feed: str) -> str:
        return f"{self.prefix}bronze.{feed}"

    @property
    def fact(self) -> str:
        return f"{self.prefix}silver.fact_sales"

    @property
    def rejects(self) -> str:
        return f"{self.prefix}silver.reject_sales"

    @property
    def sale_ids(self) -> str:
        return f"{self.prefix}silver.sale_id_filters"

    @property
    def live_sales(self) -> str:
        return f"{self.prefix}silver.live_sales"

    @property
    def missing_keys(self) -> str:
        return f"{self.prefix}silver.missing_keys"

    @property
    def gold_states(self) -> str:
        return f"{self.prefix}silver.gold_states"

    @property
    def gold_totals(self) -> str:
        return f"{self.prefix}silver.gold_totals"

    @property
    def member_numbers(self) -> str:
        return f"{self.prefix}silver.member_numbers"

    @property
    def merged_days(self) -> str:
        return f"{self.prefix}silver.merged_days"

    @property
    def job_log(self) -> str:
        return f"{self.prefix}audit.etl_job_log"

    def gold(self, table: str) -> str:
        return f"{self.prefix}gold.{table}"


def create_lake(spark: SparkSession, lake: Lake, root: str | None = None) -> None:
    """Declare all layers and tables; existing ones stay as they are."""
    for layer in ("bronze", "silver", "gold", "audit"):
        place = f"{root.rstrip('/')}/{layer}" if root else None
        create_layer(spark, f"{lake.prefix}{layer}", place)
    for name, feed in FEEDS.items():
        parts = ("_job_date", "_batch_id") if feed.dated else ()
        # Masters are broadcast by the size of their files.
        create_table(spark, lake.bronze(name), S.bronze_schema(name, feed.dated, feed.kind), parts,
                     COMPACT if feed.dated else None)
    create_table(spark, lake.fact, S.FACT_SALES, ("job_date",), COMPACT)
    create_table(spark, lake.rejects, S.REJECT_SALES, ("job_date",), COMPACT)
    create_table(spark, lake.sale_ids, S.SALE_ID_FILTERS, ("job_date",))
    create_table(spark, lake.missing_keys, S.MISSING_KEYS, ("job_date",))
    create_table(spark, lake.live_sales, S.LIVE_SALES, ("micro_batch",))
    states = T.StructType.fromDDL(STATES)
    create_table(spark, lake.gold_states, T.StructType([*states, T.StructField("job_date", T.StringType())]), ("job_date",), COMPACT)
    create_table(spark, lake.gold_totals, T.StructType([*states, T.StructField("part", T.IntegerType())]), ("part",), COMPACT)
    create_table(spark, lake.member_numbers, S.MEMBER_NUMBERS, ("job_date",))
    create_table(spark, lake.merged_days, S.MERGED_DAYS, ("job_date",))
    create_table(spark, lake.job_log, S.JOB_LOG)
    for name, schema in GOLD_TABLES.items():
        create_table(spark, lake.gold(name), schema)
