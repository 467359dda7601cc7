import os
import uuid
from datetime import datetime

import pytest
from conftest import rows, sale

from tillflow.plans.layers import Lake, create_lake
from tillflow.sources.feeds import FEEDS, feed_path
from tillflow.streaming.ingest import stream_feed
from tillflow.streaming.sales import accepted_stream, land_sales

HEADER = "transaction_id,customer_id,product_id,store_id,quantity,unit_price,discount_amount,transaction_time"
FEED = FEEDS["pos_transactions"]


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(f"live_{uuid.uuid4().hex[:8]}_")
    create_lake(spark, lake, str(tmp_path / "lake"))
    return lake


def test_ids_are_remembered_over_restarts_until_they_are_too_old(spark, lake, tmp_path):
    raw, place = str(tmp_path / "raw"), str(tmp_path / "state")

    def arrive(day, *sales):
        path = feed_path(FEED, raw, day)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as file:
            file.write("\n".join([HEADER, *(",".join(x or "" for x in s) for s in sales)]) + "\n")
        stream = stream_feed(spark, FEED, os.path.dirname(path), "s")
        land_sales(accepted_stream(stream, datetime(2026, 8, 1), "2 days"), lake.live_sales, place).awaitTermination()
        return rows(spark.table(lake.live_sales).select("transaction_id", "quantity", "_job_date"))

    first = [("a", 1, "2026-07-10"), ("b", 1, "2026-07-10")]
    assert arrive("2026-07-10", sale("a"), sale("b"), sale("b"), sale("x", quantity="0"), sale(None)) == first
    # Again, later the same day; a fault, a sale in the future.
    assert arrive("2026-07-11", sale("a", quantity="2", time="2026-07-10 23:00:00"), sale("c", time="soon"),
                  sale("d", time="2026-09-01 10:00:00")) == first
    late = arrive("2026-07-12", sale("e", time="2026-07-20 10:00:00"))
    assert late == [*first, ("e", 1, "2026-07-12")]
    # Nine days behind: too late. On time, though its id was there long ago: forgotten.
    assert arrive("2026-07-13", sale("f", time="2026-07-11 10:00:00"),
                  sale("a", quantity="3", time="2026-07-19 10:00:00")) == [
        ("a", 1, "2026-07-10"), ("a", 3, "2026-07-13"), ("b", 1, "2026-07-10"), ("e", 1, "2026-07-12")]
    assert spark.table(lake.live_sales).select("micro_batch").distinct().count() == 3
