"""Demand per key and day, in days of the calendar and not in days with sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def daily_demand(fact: DataFrame, by: str) -> DataFrame:
    return fact.where(F.col("transaction_date").isNotNull()).groupBy(by, "transaction_date").agg(
        F.sum("quantity").alias("units"), F.sum("amount").alias("revenue"))


def fill_days(daily: DataFrame, by: str, calendar: DataFrame) -> DataFrame:
    """A row for each day of ``calendar`` (``date``) from a key's first to its last; without sales units are 0.

    A key's days are listed by themselves, so no key meets the whole calendar. Days
    with sales stay even if the calendar does not know them.
    """
    spans = daily.groupBy(by).agg(F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last"))
    days = spans.select(by, F.explode(F.sequence("first", "last")).alias("transaction_date"))
    known = calendar.select(F.col("date").alias("transaction_date")).distinct()
    empty = days.join(known, "transaction_date", "left_semi").select(
        by, "transaction_date", F.lit(0).cast("long").alias("units"),
        F.lit(0).cast(daily.schema["revenue"].dataType).alias("revenue"))
    # Sums and not a join, which would lose the key that is null.
    return daily.unionByName(empty).groupBy(by, "transaction_date").agg(
        F.sum("units").alias("units"), F.sum("revenue").cast(daily.schema["revenue"].dataType).alias("revenue"))


def demand_by_day(daily: DataFrame, by: str) -> DataFrame:
    """Units seven days before, and units per day over the last 7 and 28 days.

    A day without sales counts as 0, a day before the key's first one does not count. A
    window holds one row per day of a key.
    """
    day = F.unix_date("transaction_date")
    by_day = W.partitionBy(by).orderBy("_day")
    numbered = daily.withColumn("_day", day)
    since = F.col("_day") - F.min("_day").over(W.partitionBy(by))

    def mean(days: int):
        return F.sum("units").over(by_day.rangeBetween(1 - days, 0)) / F.least(F.lit(days), F.col("_since") + 1)

    return numbered.withColumn("_since", since).withColumns(
        {
            "units_lag_7": F.when(
                F.col("_since") >= 7, F.coalesce(F.sum("units").over(by_day.rangeBetween(-7, -7)), F.lit(0))),
            "units_avg_7": mean(7),
            "units_avg_28": mean(28),
        }
    ).drop("_day", "_since")


def near_holidays(demand: DataFrame, holidays: DataFrame, before: int = 3, after: int = 1) -> DataFrame:
    """Adds the name of the holiday (``date, holiday_name``) that a day is near, and the days until it.

    Near is ``before`` days ahead to ``after`` days behind. Of several the nearest counts,
    then the earlier, then the first by name. Each holiday is listed with its days, so the
    interval is met by equality.
    """
    near = holidays.where(F.col("date").isNotNull()).select(
        F.explode(F.sequence(F.date_sub("date", before), F.date_add("date", after))).alias("transaction_date"),
        "date", "holiday_name")
    until = F.datediff("date", "transaction_date")
    nearest = near.groupBy("transaction_date").agg(
        F.min(F.struct(F.abs(until).alias("away"), "date", "holiday_name")).alias("_near"))
    joined = demand.join(nearest, "transaction_date", "left")
    return joined.select(
        *demand.columns, F.col("_near.holiday_name").alias("holiday_name"),
        F.datediff("_near.date", "transaction_date").alias("days_to_holiday"))
