import random
from datetime import datetime

from conftest import pos, rows, sale
from pyspark.sql import functions as F

from tillflow.functions.typing import typed_sales
from tillflow.operators import masters as M
from tillflow.operators.batches import choose_batch
from tillflow.operators.enrich import enrich
from tillflow.operators.masters import attach, current_rows, hot_keys
from tillflow.plans.silver import enriched_sales, prepare_masters


def sales(spark, n=900):
    draw = random.Random(3)
    keys = [None] * (n // 3) + ["hot"] * (n // 3)
    keys += [f"k{draw.randint(1, 40)}" for _ in range(n - len(keys))]
    return spark.createDataFrame(
        [(f"t{i}", key) for i, key in enumerate(keys)], "transaction_id STRING, store_id STRING"
    ).repartition(4)


def master(spark):
    known = ["hot", *[f"k{i}" for i in range(1, 31)]]
    return spark.createDataFrame([(k, f"name {k}") for k in known], "store_id STRING, store_name STRING")


def test_shuffled_join_equals_broadcast_join(spark):
    left, right = sales(spark), master(spark)
    columns = {"store_name": "store_name"}
    plain = rows(attach(left, right, "store_id", columns, found="known"))
    assert len(plain) == 900
    by_shuffle = attach(left, right, "store_id", columns, found="known", limit=-1)
    assert rows(by_shuffle) == plain
    hot = hot_keys(left, "store_id", min_rows=50)
    assert rows(hot) == [("hot", 6)]
    split = attach(left, right, "store_id", columns, found="known", limit=-1, hot=hot)
    assert rows(split) == plain


def test_keyless_and_hot_rows_are_spread_over_tasks(spark):
    """No shuffle partition of the join holds a third of the rows."""
    left, right = sales(spark, 9000), master(spark)
    from tillflow.operators import masters as M

    hot = hot_keys(left, "store_id", min_rows=100)
    side = right.selectExpr("store_id AS _key", "store_name")
    divided, _ = M._split_keys(left, side, "store_id", "transaction_id", hot)
    largest = divided.groupBy("store_id", "_slot").count().agg({"count": "max"}).first()[0]
    assert largest < 300


def test_current_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "x"), ("a", 2, "y"), ("b", 1, None), (None, 9, "z")],
        "k STRING, at INT, v STRING",
    )
    assert rows(current_rows(df, "k", ["at"])) == [("a", 2, "y"), ("b", 1, None)]


def test_keys_that_differ_in_blanks_are_one(spark):
    products = spark.createDataFrame(
        [("p1", "Old", "g", "1", datetime(2026, 1, 1)), (" p1 ", "New", "g", "1", datetime(2026, 2, 1))],
        "product_id STRING, product_name STRING, category_id STRING, unit_price STRING,"
        " _ingestion_timestamp TIMESTAMP",
    )
    found = prepare_masters({"product_master": products})["product_master"]
    assert [(r.product_id, r.product_name) for r in found.collect()] == [("p1", "New")]
    assert "_ingestion_timestamp" not in found.columns


def test_unknown_keys_are_kept_and_flagged(spark):
    left = spark.createDataFrame(
        [("t1", "p1", "c1"), ("t2", "p9", None), ("t3", "p1", "c9")],
        "transaction_id STRING, product_id STRING, customer_id STRING",
    )
    known = {
        "product_master": spark.createDataFrame(
            [("p1", "Pen", "g1")], "product_id STRING, product_name STRING, category_id STRING"
        ),
        "customer_master": spark.createDataFrame(
            [("c1", "Ann")], "customer_id STRING, customer_name STRING"
        ),
    }
    found = {r.transaction_id: r for r in enrich(left, known).collect()}
    assert found["t1"].missing_masters == []
    assert found["t2"].missing_masters == ["E006:product_id"]
    assert found["t2"].product_name is None and found["t2"].customer_name is None
    assert found["t3"].missing_masters == ["E006:customer_id"]


def test_batch_choice(spark):
    bronze = spark.createDataFrame(
        [
            ("d1", "b1", 1, "x"), ("d1", "b2", 2, "y"), ("d1", "b2", 2, "z"),
            ("d2", "b3", 1, "u"), ("d2", "b2", 3, "w"), ("d2", "b1", 2, "v"),
            ("d3", "b4", 5, "q"),
        ],
        "_job_date STRING, _batch_id STRING, _ingestion_timestamp INT, v STRING",
    )
    chosen = {r.v for r in choose_batch(bronze, "b1").collect()}
    assert chosen == {"x", "v", "q"}
    latest = {r.v for r in choose_batch(bronze, "none").collect()}
    assert latest == {"y", "z", "w", "q"}


def test_heavy_keys_are_found_by_sketches_and_split_evenly(spark):
    sales = spark.range(0, 100_000, 1, 8).selectExpr(
        "concat('t', id) AS transaction_id", "if(id % 10 < 4, 'big', concat('s', id % 5000)) AS store_id")
    hot = hot_keys(sales, "store_id", min_rows=2_000)
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "approx_top_k" in plan and "hashpartitioning" not in plan
    assert rows(hot) == [("big", 20)]
    few = hot_keys(sales, "store_id", min_rows=2_000, tracked=100).first()
    assert few._hot_key == "big" and 18 <= few._parts <= 20
    assert hot_keys(sales.where("false"), "store_id").isEmpty()
    side = spark.range(5000).selectExpr("concat('s', id) AS _key").union(spark.sql("SELECT 'big'"))
    divided, _ = M._split_keys(sales, side, "store_id", "transaction_id", hot.cache())
    sizes = sorted(r["count"] for r in divided.repartition(16, "store_id", "_slot").groupBy(
        F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]


def test_dates_and_money_are_worked_out_after_large_masters_are_joined(spark):
    master = spark.createDataFrame([("c1", "Ann")], "customer_id STRING, customer_name STRING").hint("merge")
    typed = typed_sales(pos(spark, sale("a", customer="c1"), sale("b", customer=None)))
    found = enriched_sales(typed, {"customer_master": master}, sizes={"customer_master": spark.range(10**9)})
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in text and "yyyy-MM" not in text[text.index("Join LeftOuter"):]
    assert [(r.transaction_id, r.customer_name, r.year_month) for r in found.orderBy("transaction_id").collect()] == [
        ("a", "Ann", "2026-07"), ("b", None, "2026-07")]
