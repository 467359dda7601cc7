"""Numbers and running sums over whole ordered tables, without a window that one task holds.

A table is dealt by ranges of its order and numbered in each range; what lies before
a range is a sum over ranges, of which there are as many as shuffle partitions.
Numbered rows are cut into blocks of bounded size, and blocks of blocks, for running
sums. Nothing depends on how many rows share a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.tables import written

BLOCK = 8_192
# monotonically_increasing_id has the partition above these bits, the row's number below.
ROW_BITS = 33


def numbered(df: DataFrame, order: list[str | Column], name: str = "row") -> DataFrame:
    """``df`` with ``name``: the row's number from 0 in the order of the columns ``order``, which must be total."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    held = written(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", ROW_BITS)
    counts = held.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows")).collect()
    before, total = {}, 0
    for row in sorted(counts):
        before[row["_part"]] = total
        total += row["_rows"]
    # One entry per range, whatever the table's size.
    starts = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map(
        F.lit(0), F.lit(0))
    inside = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return held.withColumn(name, (F.element_at(starts, part) + inside).cast("long")).drop("_at")


def running_sums(df: DataFrame, place: str, values: list[str], rows: int, block: int = BLOCK) -> DataFrame:
    """``df`` with each of ``values`` replaced by its sum up to and with the row.

    ``place`` numbers the rows from 0 to ``rows`` - 1 without gaps.
    """
    order = Window.partitionBy("_block").orderBy(place)
    blocked = df.withColumn("_block", F.expr(f"{place} div {block}"))
    inner = blocked.withColumns({v: F.sum(v).over(order) for v in values})
    if rows <= block:
        return inner.drop("_block")
    sums = written(blocked.groupBy("_block").agg(*[F.sum(v).alias(v) for v in values]), "block-sums")
    blocks = -(-rows // block)
    totals = running_sums(sums.withColumnRenamed("_block", "_place"), "_place", values, blocks, block)
    before = totals.select((F.col("_place") + 1).alias("_block"), *[F.col(v).alias(f"_before_{v}") for v in values])
    joined = inner.join(before, "_block", "left")
    return joined.withColumns(
        {v: F.col(v) + F.coalesce(f"_before_{v}", F.lit(0)) for v in values}
    ).drop("_block", *[f"_before_{v}" for v in values])
