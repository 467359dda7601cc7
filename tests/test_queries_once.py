"""Queries that read their sales several times write them first; keys are made once and cheaply."""

import pytest
from pyspark.sql import functions as F

from tillflow.sinks.compaction import interleaved
from tillflow.testbed import queries as Q


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dash_cross_filter", "audit_counts", "sales_rejected", "rejects_by_reason"])
def test_line_items_are_joined_once(spark, sf_dir, name):
    assert "lineitem.parquet" not in plan_of(Q.QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", [
    "sink_append", "sink_retry", "sink_compact_files", "stream_ingest",
    "stream_ids_once"])
def test_rows_written_several_times_are_made_once(spark, sf_dir, name, monkeypatch):
    settled, real = [], Q._settle
    monkeypatch.setattr(Q, "_settle", lambda rows: settled.append(plan_of(rows)) or real(rows))
    Q.QUERIES[name](spark, sf_dir)
    assert any("lineitem.parquet" in plan for plan in settled)


def test_products_are_named_after_their_sales_are_added_up(spark, sf_dir):
    plan = plan_of(Q.QUERIES["gold_product_metrics"](spark, sf_dir))
    expanded = [line for line in plan.splitlines() if "Expand" in line]
    assert expanded and "product_name" not in expanded[0]


def test_places_among_bounds_are_found_by_halves(spark):
    rows = spark.range(1000).select((F.col("id") % 97).alias("a"), F.col("id").cast("string").alias("b"))
    key = interleaved(rows, ["a", "b"])
    assert "lambdafunction" not in plan_of(rows.select(key.alias("k")))
    found = {row["k"] for row in rows.select(interleaved(rows, ["a"]).alias("k")).collect()}
    assert len(found) > 60
