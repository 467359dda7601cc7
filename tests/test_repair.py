import uuid

from conftest import pos, rows, sale
from pyspark.sql import functions as F

from tillflow.functions.typing import typed_sales
from tillflow.plans.layers import Lake, create_lake
from tillflow.plans.repair import missing_keys, note_missing, repair_days
from tillflow.plans.silver import enriched_sales, fact_rows
from tillflow.schemas import MASTER_TYPES
from tillflow.sinks.tables import append, replace_day, replace_table

EMPTY = {
    "product_master": "product_id STRING, product_name STRING, category_id STRING",
    "customer_master": "customer_id STRING, customer_name STRING",
    "store_master": "store_id STRING, store_name STRING, region STRING",
}


def masters(spark, **held):
    return {name: spark.createDataFrame(held.get(name, []), schema) for name, schema in EMPTY.items()}


def test_only_days_whose_keys_have_come_are_rewritten(spark, tmp_path):
    lake = Lake(f"repair_{uuid.uuid4().hex[:8]}_")
    create_lake(spark, lake, str(tmp_path / "lake"))
    first = masters(
        spark, product_master=[("p1", "Pen", "g1")], customer_master=[("c1", "Ada")], store_master=[("s1", "North", "N")])
    days = {
        "2026-07-10": [sale("a"), sale("b", product="p2"), sale("c", product="p2", customer="c9"), sale("d", customer=None)],
        "2026-07-11": [sale("e"), sale("f", store="s7")],
        "2026-07-12": [sale("g")],
    }
    for day, sales in days.items():
        fact = fact_rows(enriched_sales(typed_sales(pos(spark, *sales)), first), f"batch {day}", day, "tills")
        replace_day(fact, lake.fact, "job_date", day)
        note_missing(spark, lake, day)
    assert rows(spark.table(lake.missing_keys).select("job_date", "sale_column", "key", "rows")) == [
        ("2026-07-10", "customer_id", "c9", 1), ("2026-07-10", "product_id", "p2", 2),
        ("2026-07-11", "store_id", "s7", 1)]

    def files():
        return {(r.job_date, r.file) for r in spark.table(lake.fact).select(
            "job_date", F.col("_metadata.file_path").alias("file")).distinct().collect()}

    landed = {"product_master": [("p1", "Pen", "g1"), ("p2", "Ink", "g2")], "customer_master": [("c1", "Ada")],
              "store_master": [("s1", "North", "N")]}
    for name, df in masters(spark, **landed).items():
        columns = spark.table(lake.bronze(name)).columns
        assert name in MASTER_TYPES and set(df.columns) <= set(columns)
        append(df, lake.bronze(name))
    before = files()
    assert repair_days(spark, lake) == ["2026-07-10"]
    after = files()
    assert {f for f in before if f[0] > "2026-07-10"} == {f for f in after if f[0] > "2026-07-10"}
    assert not {f for f in before & after if f[0] == "2026-07-10"}
    found = spark.table(lake.fact).where("job_date = '2026-07-10'").select(
        "transaction_id", "product_name", "category_id", "missing_masters", "batch_id", "source_system")
    assert rows(found) == [
        ("a", "PEN", "g1", [], "batch 2026-07-10", "tills"), ("b", "INK", "g2", [], "batch 2026-07-10", "tills"),
        ("c", "INK", "g2", ["E006:customer_id"], "batch 2026-07-10", "tills"),
        ("d", "PEN", "g1", [], "batch 2026-07-10", "tills")]
    assert rows(spark.table(lake.missing_keys).select("job_date", "key", "rows")) == [
        ("2026-07-10", "c9", 1), ("2026-07-11", "s7", 1)]
    # Nothing new has come.
    assert repair_days(spark, lake) == [] and files() == after
    assert missing_keys(spark.table(lake.fact).where("job_date = '2026-07-12'")).isEmpty()
    replace_table(spark.table(lake.bronze("product_master")).where("false"), lake.bronze("product_master"))
    assert repair_days(spark, lake) == []
