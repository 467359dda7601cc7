"""Data quality counts over typed sales and their masters."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The fields each check looks at.
REQUIRED_FIELDS = ("transaction_id", "product_id", "store_id", "quantity", "unit_price")
POSITIVE_FIELDS = ("quantity", "unit_price")
NUMERIC_FIELDS = ("quantity", "unit_price", "discount_amount")
SALES_REFERENCES = {
    "product_id": "product_master",
    "customer_id": "customer_master",
    "store_id": "store_master",
}


def _report(counts: DataFrame, cells: list[tuple[str, str, str]]) -> DataFrame:
    """One row of named counts as rows of (check, field, failed_rows)."""
    rows = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(field).alias("field"),
            F.col(name).cast("bigint").alias("failed_rows"),
        )
        for check, field, name in cells
    ]
    return counts.select(F.inline(F.array(*rows)))


def null_counts(sales: DataFrame, fields: tuple[str, ...] = REQUIRED_FIELDS) -> DataFrame:
    counts = sales.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in fields])
    return _report(counts, [("null", f, f) for f in fields])


def negative_counts(sales: DataFrame, fields: tuple[str, ...] = POSITIVE_FIELDS) -> DataFrame:
    counts = sales.agg(*[F.count_if(F.col(f) < 0).alias(f) for f in fields])
    return _report(counts, [("negative", f, f) for f in fields])


def unreadable_counts(
    bronze: DataFrame, types: Mapping[str, str], fields: tuple[str, ...] = NUMERIC_FIELDS
) -> DataFrame:
    """Values present as text that are not of the field's type."""
    counts = bronze.agg(
        *[
            F.count_if(F.col(f).isNotNull() & F.col(f).try_cast(types[f]).isNull()).alias(f)
            for f in fields
        ]
    )
    return _report(counts, [("unreadable", f, f) for f in fields])


def _surplus(key: str):
    """Rows beyond the first of each key; rows without a key share one."""
    distinct = F.count_distinct(F.col(key)) + F.max(F.col(key).isNull().cast("int"))
    return F.coalesce(F.count("*") - distinct, F.lit(0))


def duplicate_count(sales: DataFrame, key: str = "transaction_id") -> DataFrame:
    counts = sales.agg(_surplus(key).alias("surplus"))
    return _report(counts, [("duplicate", key, "surplus")])


def field_checks(sales: DataFrame) -> DataFrame:
    """Total, duplicates, missing and negative values in one pass over the sales."""
    measures = [F.count("*").alias("total"), _surplus("transaction_id").alias("surplus")]
    cells = [("total", "*", "total"), ("duplicate", "transaction_id", "surplus")]
    for field in REQUIRED_FIELDS:
        measures.append(F.count_if(F.col(field).isNull()).alias(f"null_{field}"))
        cells.append(("null", field, f"null_{field}"))
    for field in POSITIVE_FIELDS:
        measures.append(F.count_if(F.col(field) < 0).alias(f"negative_{field}"))
        cells.append(("negative", field, f"negative_{field}"))
    return _report(sales.agg(*measures), cells)


def orphans(rows: DataFrame, master: DataFrame, key: str, skip_null: bool = False) -> DataFrame:
    """Distinct key values the master lacks; a missing key is one such value.

    Keys are made distinct before the join, so a frequent key costs one row.
    """
    keys = rows.select(key)
    if skip_null:
        keys = keys.where(F.col(key).isNotNull())
    return keys.distinct().join(master.select(key), key, "left_anti")


def orphan_counts(sales: DataFrame, masters: Mapping[str, DataFrame]) -> DataFrame:
    """Unknown key values per reference, guests not counted as unknown customers.

    All keys of the sales are taken in one pass and made distinct before the
    join; the key values of all masters are joined at once.
    """
    references = {key: name for key, name in SALES_REFERENCES.items() if name in masters}
    pairs = ", ".join(f"'{key}', {key}" for key in references)
    used = sales.selectExpr(f"stack({len(references)}, {pairs}) AS (field, key)")
    used = used.where("field <> 'customer_id' OR key IS NOT NULL")
    if "product_master" in masters and "category_master" in masters:
        references["category_id"] = "category_master"
        used = used.unionByName(
            masters["product_master"].selectExpr("'category_id' AS field", "category_id AS key")
        )
    known = [
        masters[name].selectExpr(f"'{key}' AS field", f"{key} AS key")
        for key, name in references.items()
    ]
    unknown = used.distinct().join(
        reduce(DataFrame.unionByName, known), ["field", "key"], "left_anti"
    )
    counts = unknown.agg(*[F.count_if(F.col("field") == key).alias(key) for key in references])
    return _report(counts, [("orphan", key, key) for key in references])


def quality_report(sales: DataFrame, masters: Mapping[str, DataFrame]) -> DataFrame:
    """All checks as (check, field, failed_rows)."""
    return field_checks(sales).unionByName(orphan_counts(sales, masters))


def issue_summary(report: DataFrame) -> DataFrame:
    """One row: records, duplicates, fields checked, checks that found something."""

    def of(check: str):
        return F.sum(F.when(F.col("check") == check, F.col("failed_rows")))

    failed = (F.col("check") != "total") & (F.col("failed_rows") > 0)
    return report.agg(
        of("total").alias("total_records"),
        of("duplicate").alias("duplicate_records"),
        F.count_if(F.col("check") == "null").alias("fields_checked"),
        F.count_if(failed).alias("checks_failed"),
    )


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """Rows with repeated keys reduced to the least by all columns.

    Rows without a key count as copies of one key. Copies combine before the
    shuffle, and which one stays does not depend on the run.
    """
    least = rows.groupBy(F.col(key).alias("_id")).agg(
        F.min(F.struct(*rows.columns)).alias("_row")
    )
    return least.select("_row.*")
