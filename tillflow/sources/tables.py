"""Reading catalogue tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLES = "spark.sql.shuffle.partitions"


def rows_of(
    spark: SparkSession, table: str, batch_id: str | None = None, **partition: str
) -> DataFrame:
    """A table, optionally one partition and one batch of it.

    Bronze tables keep the batch in ``_batch_id``, later layers in ``batch_id``.
    """
    rows = spark.table(table)
    for name, value in partition.items():
        rows = rows.where(F.col(name) == value)
    if batch_id is not None:
        column = "_batch_id" if "_batch_id" in rows.columns else "batch_id"
        rows = rows.where(F.col(column) == batch_id)
    return rows


def planned_bytes(df: DataFrame) -> int:
    """The planner's size estimate of a DataFrame."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Input per shuffle partition: files hold a sale in about 18 bytes, and an aggregation with
# several distinct counts takes some 370 bytes of memory for it. What the planner says of a table it has not listed
# is larger than UNKNOWN_BYTES.
SHUFFLE_BYTES = 32 * 1024 * 1024
UNKNOWN_BYTES = 2**60


def fit_shuffles(spark: SparkSession, *inputs: DataFrame, at_most: int | None = None) -> int:
    """Raise the session's shuffle partitions to what the inputs need.

    Never lowers them: adaptive execution joins partitions that turn out small,
    but cannot divide those of an aggregation that turn out too large. Inputs
    whose size the planner does not know are an error: filter a partitioned table
    by its partitions first. ``at_most`` is the most partitions wanted, if any.
    """
    sizes = [planned_bytes(df) for df in inputs]
    if any(size >= UNKNOWN_BYTES for size in sizes):
        raise ValueError("the planner does not know the size of an input")
    needed = -(-sum(sizes) // SHUFFLE_BYTES)
    if at_most is not None:
        needed = min(needed, at_most)
    current = int(spark.conf.get(SHUFFLES))
    if needed > current:
        spark.conf.set(SHUFFLES, needed)
    return max(current, needed)


@contextmanager
def fitted_shuffles(spark: SparkSession, *inputs: DataFrame) -> Iterator[int]:
    """As ``fit_shuffles``, for the plans run inside; the setting is put back afterwards."""
    before = spark.conf.get(SHUFFLES)
    try:
        yield fit_shuffles(spark, *inputs)
    finally:
        spark.conf.set(SHUFFLES, before)


def query(spark: SparkSession, statement: str, **inputs: DataFrame) -> DataFrame:
    """Spark SQL in which each ``{name}`` stands for the DataFrame of that name."""
    return spark.sql(statement, **inputs)


def sample(df: DataFrame, rows: int = 5) -> DataFrame:
    """Any first rows, for looking at."""
    return df.limit(rows)
