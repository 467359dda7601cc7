"""Files to gold: landing, sinks, whole days, streams."""

import json
import os
import uuid
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillflow.functions.lineage import add_lineage
from tillflow.plans.day import run_day
from tillflow.plans.landing import backfill, land_all, land_feed
from tillflow.plans.layers import Lake, create_lake
from tillflow.plans.silver import build_silver
from tillflow.schemas import FEED_COLUMNS
from tillflow.session import temporary_workspace, workspace
from tillflow.sinks import tables as sinks
from tillflow.sinks import compaction
from tillflow.sinks.compaction import compact, file_sizes, finish_compaction, interleaved
from tillflow.sinks.tables import (
    append,
    create_layer,
    create_table,
    describe,
    partition_columns,
    replace_day,
    replace_partitions,
    replace_table,
    restore_table,
    with_retry,
)
from tillflow.sources.feeds import FEEDS, FeedError, feed_path, open_feed, read_files
from tillflow.sources import tables
from tillflow.sources.tables import fit_shuffles, fitted_shuffles, query, rows_of, sample
from tillflow.streaming.ingest import land_stream, stream_feed

DAY = "2026-07-10"
AS_OF = datetime(2026, 7, 12)
POS_HEADER = ",".join(FEED_COLUMNS["pos_transactions"])
SALES = [
    "t1,c1,p1,s1,2,10.00,1.00,2026-07-10 10:00:00",
    "t2,,p2,s1,1,5.00,,2026-07-10 11:00:00",
    "t3,c1,p9,s1,1,5.00,0.00,2026-07-10 12:00:00",
    "t1,c1,p1,s1,2,10.00,1.00,2026-07-10 10:00:00",
    "t4,c1,p1,s1,abc,10.00,1.00,2026-07-10 10:00:00",
    ",c1,p1,s1,1,10.00,1.00,2026-07-10 10:00:00",
]


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


def line(feed, **values):
    return ",".join(values.get(c, "") for c in FEED_COLUMNS[feed])


@pytest.fixture()
def raw(spark, tmp_path):
    """One raw file per feed."""
    root = str(tmp_path / "raw")

    def put(name, *lines):
        write(feed_path(FEEDS[name], root, DAY), *lines)

    put("pos_transactions", POS_HEADER, *SALES)
    order = {"order_id": 7, "customer_id": "c1", "price": 1.50, "quantity": 2}
    put("online_orders", json.dumps(order).replace("1.5,", "1.50,"))
    put("web_clickstream", "t INFO ip=1.1.1.1 user_id=c1 page=/a action=view", "t")
    put("customer_master", json.dumps(
        {"customer_id": "c1", "customer_name": " Ann ", "email": "A@X.com", "phone": "1-2"}
    ))
    put("coupon_dispatches", json.dumps({"coupon_id": 1, "customer_id": "c1"}))
    for name, values in {
        "loyalty_members": {"customer_id": "c1"},
        "product_master": {"product_id": "p1", "product_name": "Pen", "category_id": "g1"},
        "supplier_master": {"supplier_id": "x"},
        "store_master": {"store_id": "s1", "store_name": "Main", "region": "East"},
        "retail_calendar": {"date": DAY, "fiscal_year": "2026", "is_retail_peak": "true"},
        "holiday_calendar": {"date": DAY, "country": "JP"},
    }.items():
        put(name, ",".join(FEED_COLUMNS[name]), line(name, **values))
    with open(feed_path(FEEDS["product_master"], root), "a") as out:
        out.write(line("product_master", product_id="p2", product_name="Ink", category_id="g1") + "\n")
    put("category_master", "category_id,category_name,parent_category,category_level", "g1,Office,,1")
    stock = spark.createDataFrame(
        [("p1", "s1", 5, 1, date(2026, 7, 9))],
        "product_id STRING, store_id STRING, quantity_on_hand INT, quantity_reserved INT,"
        " last_updated DATE",
    )
    stock.write.parquet(feed_path(FEEDS["inventory_balance"], root))
    return root


@pytest.fixture()
def lake(spark, tmp_path):
    made = Lake(f"l{abs(hash(str(tmp_path)))}_")
    create_lake(spark, made, str(tmp_path / "lake"))
    return made


def test_paths():
    assert feed_path(FEEDS["pos_transactions"], "/r/", DAY) == (
        "/r/pos/transactions/pos_transactions_20260710.csv"
    )
    assert feed_path(FEEDS["web_clickstream"], "/r", DAY).endswith("web_clickstream_20260710.log")
    assert feed_path(FEEDS["online_orders"], "/r") == "/r/ecommerce/online_orders_*.json"
    assert feed_path(FEEDS["store_master"], "/r") == "/r/erp/store_master.csv"
    with pytest.raises(ValueError):
        feed_path(FEEDS["pos_transactions"], "/r", "10.07.2026")


def test_all_feeds_land_as_text(spark, lake, raw):
    counts = land_all(spark, lake, raw, DAY, "b1")
    assert counts == {**dict.fromkeys(FEEDS, 1), "pos_transactions": 6, "product_master": 2,
                      "web_clickstream": 2}
    for name in FEEDS:
        table = spark.table(lake.bronze(name))
        assert set(FEED_COLUMNS[name]) <= set(table.columns)
        kinds = {f.dataType.simpleString() for f in table.schema.fields if f.name[0] != "_"}
        assert kinds == {"string"}
        row = table.first()
        assert row["_batch_id"] == "b1" and FEEDS[name].name in row["_source_file"]
        assert row["_ingestion_timestamp"] is not None
        assert ("_job_date" in table.columns) == FEEDS[name].dated
    order = spark.table(lake.bronze("online_orders")).first()
    assert (order.price, order.quantity, order.order_id) == ("1.50", "2", "7")
    assert spark.table(lake.bronze("inventory_balance")).first().last_updated == "2026-07-09"
    assert "parent_category_id" in spark.table(lake.bronze("category_master")).columns


def test_landing_again_adds_nothing_and_keeps_other_days(spark, lake, raw):
    land_feed(spark, lake, "pos_transactions", raw, DAY, "b1")
    land_feed(spark, lake, "pos_transactions", raw, DAY, "b2")
    write(feed_path(FEEDS["pos_transactions"], raw, "2026-07-11"), POS_HEADER, SALES[0])
    land_feed(spark, lake, "pos_transactions", raw, "2026-07-11", "b1")
    land_feed(spark, lake, "pos_transactions", raw, DAY, "b1")
    table = spark.table(lake.bronze("pos_transactions"))
    assert rows(table.groupBy("_job_date", "_batch_id").count()) == [
        (DAY, "b1", 6), (DAY, "b2", 6), ("2026-07-11", "b1", 1),
    ]


def test_backfill_reads_days_from_names(spark, lake, raw):
    write(feed_path(FEEDS["pos_transactions"], raw, "2026-07-11"), POS_HEADER, *SALES[:2])
    backfill(spark, lake, "pos_transactions", raw, "all")
    table = spark.table(lake.bronze("pos_transactions"))
    assert rows(table.groupBy("_job_date").count()) == [(DAY, 6), ("2026-07-11", 2)]


def test_files_with_columns_in_another_order_are_not_mixed_up(spark, tmp_path):
    path = str(tmp_path / "pos_transactions_*.csv")
    write(str(tmp_path / "pos_transactions_20260710.csv"), POS_HEADER, SALES[0])
    turned = ",".join(reversed(POS_HEADER.split(",")))
    write(str(tmp_path / "pos_transactions_20260711.csv"), turned, SALES[0])
    with pytest.raises(Exception, match="CSV header"):
        read_files(spark, FEEDS["pos_transactions"], path).collect()


def test_missing_and_empty_sources(spark, tmp_path):
    feed = FEEDS["pos_transactions"]
    with pytest.raises(FeedError) as missing:
        open_feed(spark, feed, str(tmp_path / "none.csv"))
    assert missing.value.code == "E002"
    write(str(tmp_path / "empty.csv"), POS_HEADER)
    with pytest.raises(FeedError) as empty:
        open_feed(spark, feed, str(tmp_path / "empty.csv"))
    assert empty.value.code == "E002"
    write(str(tmp_path / "other.csv"), "a,b", "1,2")
    with pytest.raises(FeedError) as other:
        open_feed(spark, feed, str(tmp_path / "other.csv"))
    assert other.value.code == "E003"


def test_short_and_long_csv_rows(spark, tmp_path):
    path = str(tmp_path / "h.csv")
    write(path, "date,holiday_name,holiday_type,country", "2026-01-01,New Year", "a,b,c,d,e,f")
    found = read_files(spark, FEEDS["holiday_calendar"], path).drop("_source_file")
    assert rows(found) == sorted(
        [("2026-01-01", "New Year", None, None, "2026-01-01,New Year"), ("a", "b", "c", "d", "a,b,c,d,e,f")],
        key=repr,
    )


def test_json_keeps_what_the_contract_does_not_name(spark, tmp_path):
    path = str(tmp_path / "online_orders_20260710.json")
    write(path, '{"order_id": 1.50, "gift": {"a": 1}}', "no json", "", '{"order_id": null}')
    found = read_files(spark, FEEDS["online_orders"], path)
    assert rows(found.select("order_id", "_corrupt_record", "_extra_fields")) == sorted(
        [("1.50", None, '{"gift":"{\\"a\\":1}"}'), (None, "no json", None), (None, None, None)], key=repr)


def test_a_file_without_a_day_is_not_backfilled(spark, lake, raw):
    write(feed_path(FEEDS["pos_transactions"], raw, DAY).replace("20260710", "latest"), POS_HEADER, SALES[0])
    with pytest.raises(FeedError, match="E003"):
        backfill(spark, lake, "pos_transactions", raw, "all")
    assert spark.table(lake.bronze("pos_transactions")).isEmpty()


def test_a_day_from_files_to_gold(spark, lake, raw):
    for batch in ("b1", "b2", "b2"):
        run_day(spark, lake, raw, DAY, batch, AS_OF)
        fact = {r.transaction_id: r for r in spark.table(lake.fact).collect()}
        assert fact.keys() == {"t1", "t2", "t3"}
        assert (fact["t1"].product_name, fact["t1"].customer_name) == ("PEN", "ANN")
        assert (fact["t1"].category_name, fact["t1"].store_region) == ("OFFICE", "EAST")
        assert fact["t1"].is_retail_peak is True and fact["t1"].batch_id == batch
        assert fact["t3"].missing_masters == ["E006:product_id"]
        assert spark.table(lake.rejects).count() == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    size = tables.planned_bytes(spark.table(lake.fact).where("job_date IS NOT NULL"))
    assert 0 < size < tables.UNKNOWN_BYTES
    daily = spark.table(lake.gold("daily_sales_summary")).first()
    assert (daily.transaction_count, str(daily.total_sales)) == (3, "30.00")
    assert spark.table(lake.gold("category_metrics")).agg({"revenue_share_pct": "sum"}).first()[0] == 100
    log = spark.table(lake.job_log)
    assert {(r.status, r.records_read, r.records_processed, r.records_rejected) for r in log.collect()} == {
        ("SUCCESS", 6, 3, 3)
    }
    assert log.count() == 3


def test_failed_day_is_logged(spark, lake, tmp_path):
    with pytest.raises(FeedError):
        run_day(spark, lake, str(tmp_path / "nothing"), DAY, "b1", AS_OF)
    row = spark.table(lake.job_log).first()
    assert row.status == "FAILED" and "E002" in row.error_message


def test_day_with_only_rejects_clears_the_fact(spark, lake, raw):
    run_day(spark, lake, raw, DAY, "b1", AS_OF)
    write(feed_path(FEEDS["pos_transactions"], raw, DAY), POS_HEADER, SALES[4])
    run_day(spark, lake, raw, DAY, "b2", AS_OF)
    assert spark.table(lake.fact).isEmpty()
    assert spark.table(lake.rejects).count() == 1


@pytest.fixture()
def layer(spark, tmp_path):
    name = f"s{abs(hash(str(tmp_path)))}"
    create_layer(spark, name, str(tmp_path / "tables"))
    return name


def test_partitions_evolve_and_append(spark, layer):
    table = f"{layer}.t"
    first = spark.createDataFrame([(1, "d1"), (2, "d2")], "v INT, job_date STRING")
    create_table(spark, table, first.schema, ["job_date"])
    replace_partitions(first, table)
    wider = spark.createDataFrame([(5, "d2", "x")], "v INT, job_date STRING, extra STRING")
    replace_partitions(wider, table, evolve=True)
    assert rows(spark.table(table).select("v", "job_date", "extra")) == [(1, "d1", None), (5, "d2", "x")]
    append(first, table)
    assert spark.table(table).count() == 4
    assert rows(rows_of(spark, table, job_date="d1").select("v")) == [(1,), (1,)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    detail = describe(spark, table).first()
    assert detail.format.lower() == "parquet" and detail.partition_columns == ["job_date"]
    assert detail.location.endswith("/t")


def test_full_refresh_replaces_columns(spark, layer):
    table = f"{layer}.m"
    replace_table(spark.range(3), table)
    replace_table(spark.createDataFrame([("a",)], "k STRING"), table)
    assert rows(spark.table(table)) == [("a",)]
    assert sample(spark.table(table), 1).count() == 1
    assert query(spark, "SELECT upper(k) AS k FROM {t}", t=spark.table(table)).first().k == "A"


def test_compaction(spark, layer):
    table = f"{layer}.c"
    df = spark.range(1000).selectExpr("id AS v", "if(id < 500, 'd1', 'd2') AS job_date")
    create_table(spark, table, df.schema, ["job_date"])
    for part in range(4):
        append(df.where(f"v % 4 = {part}"), table)
    before = rows(spark.table(table))
    assert file_sizes(rows_of(spark, table, job_date="d1")).count() > 1
    assert compact(spark, table, job_date="d1") == 1
    assert file_sizes(rows_of(spark, table, job_date="d1")).count() == 1
    assert file_sizes(rows_of(spark, table, job_date="d2")).count() > 1
    assert rows(spark.table(table)) == before
    place = os.path.dirname(describe(spark, table).first().location.removeprefix("file:"))
    assert os.listdir(place) == ["c"]
    assert compact(spark, table, job_date="none") == 0


def _names(spark, table, **partition):
    return {os.path.basename(file) for file in rows_of(spark, table, **partition).inputFiles()}


def test_large_files_keep_their_names(spark, layer):
    table = f"{layer}.files"
    df = spark.range(40_000).selectExpr("id AS v", "uuid() AS text", "'d 1' AS job_date")
    create_table(spark, table, df.schema, ["job_date"])
    append(df, table)
    large = _names(spark, table)
    for part in range(5):
        append(df.where(f"v % 97 = {part}"), table)
    append(df.limit(3).withColumn("text", F.lit(None)), table)
    before = rows(spark.table(table).groupBy("v", "job_date").count())
    size = min(r.bytes for r in file_sizes(spark.table(table)).where("bytes > 100000").collect())
    assert compact(spark, table, target_bytes=size, job_date="d 1") == 1
    after = _names(spark, table)
    assert large < after and len(after) == len(large) + 1
    assert rows(spark.table(table).groupBy("v", "job_date").count()) == before
    assert compact(spark, table, target_bytes=size) == 0
    assert _names(spark, table) == after


def test_sorted_compaction_lets_filters_on_any_column_read_fewer_files(spark, layer):
    table = f"{layer}.z"
    df = spark.range(20_000).selectExpr(
        "concat('S', lpad(hash(id) & 63, 3, '0')) AS store", "hash(id, 1) & 63 AS product", "uuid() AS text",
        "'d1' AS job_date")
    create_table(spark, table, df.schema, ["job_date"])
    df.repartition(40).write.insertInto(table)
    before = spark.table(table).select("store", "product").orderBy("store", "product").collect()

    def read_by(condition):
        return file_sizes(spark.table(table).where(condition)).count()

    assert read_by("store = 'S007'") == read_by("product = 7") == 40
    total = file_sizes(spark.table(table)).agg(F.sum("bytes")).first()[0]
    made = compact(spark, table, target_bytes=total // 16, order_by=["store", "product"], job_date="d1")
    assert made in (16, 17)
    assert read_by("store = 'S007'") <= made // 2 and read_by("product = 7") <= made // 2
    assert spark.table(table).select("store", "product").orderBy("store", "product").collect() == before


def test_interleaved_bits(spark):
    df = spark.createDataFrame(
        [(a, b) for a in ("a", "b", "c", "d") for b in (1, 2, 3, 4)] + [(None, 4)], "a STRING, `b x` INT")
    found = {(r[0], r[1]): r.z for r in df.withColumn("z", interleaved(df, ["a", "b x"])).collect()}
    assert len(set(found.values())) == 17 and found[None, 4] < found["a", 4]
    quarters = [[found[a, b] for a in stores for b in products]
                for stores in ("ab", "cd") for products in ((1, 2), (3, 4))]
    assert all(max(low) < min(high) for low, high in zip(quarters, quarters[1:]))
    # Few values weigh as much as many.
    many = spark.range(64).selectExpr("id AS n", "id % 2 AS flag")
    by_key = [r.flag for r in many.orderBy(interleaved(many, ["n", "flag"]), "n").collect()]
    assert set(by_key[:16]) == {0} and set(by_key[16:31]) == {1}
    nothing = df.limit(0)
    assert nothing.withColumn("z", interleaved(nothing, ["a"])).count() == 0


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_an_interrupted_exchange_of_files_is_finished(spark, layer, monkeypatch, moved):
    table = f"{layer}.broken"
    df = spark.range(900).selectExpr("id AS v", "'d1' AS job_date")
    create_table(spark, table, df.schema, ["job_date"])
    for part in range(3):
        append(df.where(f"v % 3 = {part}"), table)
    before = rows(spark.table(table))
    whole, old = compaction._exchange, _names(spark, table)

    def broken(spark, folder):
        if not compaction._files(spark, compaction._path(spark, folder, uri=False)).exists(
                compaction._path(spark, f"{folder}/{compaction.PLAN}", uri=False)):
            return whole(spark, folder)
        place = folder.removeprefix("file:")
        plan = json.load(open(f"{place}/{compaction.PLAN}"))
        if moved:
            for name in plan["new"]:
                os.rename(f"{place}/{plan['staged']}/{name}", f"{place}/{name}")
        if moved == 2:
            os.remove(f"{place}/{plan['old'][0]}")
        raise RuntimeError("lost")

    monkeypatch.setattr(compaction, "_exchange", broken)
    with pytest.raises(RuntimeError, match="lost"):
        compact(spark, table)
    if not moved:
        assert rows(spark.table(table)) == before and _names(spark, table) == old
    monkeypatch.setattr(compaction, "_exchange", whole)
    spark.catalog.refreshTable(table)
    assert finish_compaction(spark, table) == 1
    assert rows(spark.table(table)) == before and len(_names(spark, table)) == 1
    assert finish_compaction(spark, table) == 0 and compact(spark, table) == 0
    folder = os.path.dirname(spark.table(table).inputFiles()[0].removeprefix("file://"))
    assert not [name for name in os.listdir(folder) if name.startswith("_c")]


def test_staged_files_without_a_plan_are_removed(spark, layer, monkeypatch):
    table = f"{layer}.unplanned"
    df = spark.range(10).selectExpr("id AS v", "'d1' AS job_date")
    create_table(spark, table, df.schema, ["job_date"])
    append(df, table)
    append(df, table)
    before = rows(spark.table(table))
    with monkeypatch.context() as patch:
        digests = iter(((1, 1), (2, 2)))
        patch.setattr(compaction, "_digest", lambda rows: next(digests))
        with pytest.raises(RuntimeError, match="differs"):
            compact(spark, table)
    assert rows(spark.table(table)) == before
    assert finish_compaction(spark, table) == 0
    folder = os.path.dirname(spark.table(table).inputFiles()[0].removeprefix("file://"))
    assert not [name for name in os.listdir(folder) if name.startswith("_c")]
    assert compact(spark, table) == 1 and rows(spark.table(table)) == before


def test_retry(spark, tmp_path):
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            spark.sql("SELECT raise_error('lost')").collect()
        return "done"

    assert with_retry(flaky, wait=0) == "done" and len(calls) == 3
    with pytest.raises(RuntimeError, match="E005"):
        with_retry(lambda: spark.sql("SELECT raise_error('lost')").collect(), attempts=2, wait=0)
    calls.clear()

    def wrong():
        calls.append(1)
        spark.read.parquet(str(tmp_path / "none"))

    with pytest.raises(AnalysisException):
        with_retry(wrong, wait=0)
    assert len(calls) == 1


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_write_that_fails_once_keeps_every_row(spark, layer, monkeypatch, when):
    table = f"{layer}.d"
    df = spark.range(1000).selectExpr("id AS v", "'d1' AS job_date")
    create_table(spark, table, df.schema, ["job_date"])
    replace_day(df.limit(10), table, "job_date", "d1")
    real, calls = sinks.replace_partitions, []

    def flaky(rows, name, evolve=False):
        calls.append(1)
        if when == "after" or len(calls) > 1:
            real(rows, name, evolve)
        if len(calls) == 1:
            spark.sql("SELECT raise_error('lost')").collect()

    monkeypatch.setattr(sinks, "replace_partitions", flaky)
    assert replace_day(df, table, "job_date", "d1") == 1000 and len(calls) == 2
    assert spark.table(table).count() == 1000
    assert replace_day(df.where("v < 0"), table, "job_date", "d1") == 0
    assert spark.table(table).isEmpty()


def test_a_failed_refresh_keeps_the_table(spark, layer):
    table = f"{layer}.r"
    replace_table(spark.range(3), table)
    with pytest.raises(Exception, match="lost"):
        replace_table(spark.sql("SELECT CAST(raise_error('lost') AS BIGINT) AS id"), table)
    assert spark.table(table).count() == 3
    replace_table(spark.range(5), table)
    assert spark.table(table).count() == 5


@pytest.mark.parametrize("statement", ["CREATE TABLE", "RENAME TO {}__former", "RENAME TO {}", "DROP TABLE {}__former"])
def test_a_refresh_with_other_columns_never_loses_the_table(spark, layer, monkeypatch, statement):
    table = f"{layer}.t{uuid.uuid4().hex[:6]}"
    replace_table(spark.range(3), table)
    real, stop = spark.sql, statement.format(table)

    def failing(text, *args, **more):
        if text.endswith(stop) or (stop == "CREATE TABLE" and text.startswith(stop)):
            raise RuntimeError("lost")
        return real(text, *args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(spark, "sql", failing)
        with pytest.raises(RuntimeError, match="lost"):
            replace_table(spark.range(5).selectExpr("id", "id AS more"), table)
    restore_table(spark, table)
    done = statement.startswith("DROP")
    assert spark.table(table).count() == (5 if done else 3)
    replace_table(spark.range(7).selectExpr("id", "id AS other"), table)
    assert spark.table(table).columns == ["id", "other"] and spark.table(table).count() == 7
    assert not spark.catalog.tableExists(table + "__former")


def test_a_reader_keeps_the_folder_before(spark, layer):
    table = f"{layer}.kept"
    replace_table(spark.range(3), table)
    reading = spark.table(table)
    replace_table(spark.range(4), table)
    assert reading.count() in (3, 4)
    place = os.path.dirname(spark.table(table).select("_metadata.file_path").first()[0].removeprefix("file:"))
    for _ in range(3):
        replace_table(spark.range(4), table)
    assert not os.path.exists(place)
    folders = [f for f in os.listdir(os.path.dirname(place)) if f.startswith("kept-")]
    assert len(folders) == 2


def test_a_day_that_was_not_landed_leaves_the_fact_alone(spark, lake, raw):
    run_day(spark, lake, raw, DAY, "b1", AS_OF)
    before = rows(spark.table(lake.fact))
    with pytest.raises(FeedError, match="E002"):
        build_silver(spark, lake, "2026-07-12", "b1", AS_OF)
    assert rows(spark.table(lake.fact)) == before


def test_a_cluster_needs_a_shared_folder(spark):
    class Cluster:
        conf = {}

        class sparkContext:
            master = "local-cluster[2,1,1024]"

    with pytest.raises(ValueError, match="checkpoint"):
        workspace(Cluster, "x")
    with temporary_workspace(spark, "t") as folder:
        first, second = folder(), folder()
        spark.range(3).write.parquet(first)
        assert first != second and os.path.isdir(first)
    assert not os.path.exists(first)


def test_stream_equals_batch_and_reads_each_file_once(spark, lake, raw, tmp_path):
    feed = FEEDS["pos_transactions"]
    folder, table = os.path.dirname(feed_path(feed, raw, DAY)), lake.bronze("pos_transactions")

    def run(state="state"):
        stream = stream_feed(spark, feed, folder, "s1", files_per_trigger=1)
        land_stream(stream, table, str(tmp_path / state)).awaitTermination()
        return spark.table(table)

    columns = [*FEED_COLUMNS["pos_transactions"], "_job_date"]
    batch = add_lineage(read_files(spark, feed, feed_path(feed, raw, DAY)), "s1", DAY)
    assert rows(run().select(columns)) == rows(batch.select(columns))
    write(feed_path(feed, raw, "2026-07-11"), POS_HEADER, SALES[0])
    assert run().count() == 7
    assert rows(run().select("_job_date", "_batch_id").distinct()) == [
        (DAY, "s1-000000000"), ("2026-07-11", "s1-000000001")]
    # A stream that forgot what it did lands the same batches again, in the same order.
    assert run("fresh").count() == 7
    land_all(spark, lake, raw, DAY, "b", [n for n in FEEDS if not FEEDS[n].dated])
    assert build_silver(spark, lake, DAY, "s1", AS_OF) == (6, 3, 3)


@pytest.mark.parametrize("name", ["web_clickstream", "online_orders", "store_master"])
def test_streams_of_other_formats(spark, lake, raw, tmp_path, name):
    feed = FEEDS[name]
    folder = os.path.dirname(feed_path(feed, raw, DAY))
    stream = stream_feed(spark, feed, folder, "s1")
    land_stream(stream, lake.bronze(name), str(tmp_path / "c")).awaitTermination()
    batch = read_files(spark, feed, feed_path(feed, raw, DAY))
    columns = FEED_COLUMNS[name]
    assert rows(spark.table(lake.bronze(name)).select(columns)) == rows(batch.select(columns))


def test_shuffles_grow_with_the_input_and_never_shrink(spark, monkeypatch):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    assert fit_shuffles(spark, spark.range(10)) == int(before)
    monkeypatch.setattr(tables, "planned_bytes", lambda df: 100 * tables.SHUFFLE_BYTES)
    try:
        assert fit_shuffles(spark, spark.range(10)) == 100 == int(spark.conf.get(key))
        monkeypatch.setattr(tables, "planned_bytes", lambda df: 10**15)
        assert fit_shuffles(spark, spark.range(10), at_most=500) == 500
        with fitted_shuffles(spark, spark.range(10)) as wanted:
            assert wanted == -(-(10**15) // tables.SHUFFLE_BYTES) == int(spark.conf.get(key))
        assert int(spark.conf.get(key)) == 500
        monkeypatch.setattr(tables, "planned_bytes", lambda df: tables.UNKNOWN_BYTES)
        with pytest.raises(ValueError, match="size"):
            fit_shuffles(spark, spark.range(10))
    finally:
        spark.conf.set(key, before)


def test_a_partition_has_sales_that_fit_a_task(spark, monkeypatch):
    """A gigabyte of sales, about 57 million rows, is not aggregated in two tasks."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    monkeypatch.setattr(tables, "planned_bytes", lambda df: 1 << 30)
    try:
        assert fit_shuffles(spark, spark.range(10)) >= 32
    finally:
        spark.conf.set(key, before)


def test_numbers_of_json_lines_stay_as_written(spark, tmp_path):
    path = str(tmp_path / "online_orders_20260710.json")
    as_written = ["1.50", "-2.500", "7", "-7", "0", "-0", "0.0", "1e2", "1.20E+3", "12345678901234567890", "00012.50"]
    write(path, *[f'{{"order_id": {n}, "payment_method": "5-LOW"}}' for n in as_written[:-1]], '{"order_id": "00012.50"}',
          # Text is no number, and a nested field is another one.
          '{"customer_id": {"order_id": 1.50}, "order_id": "1.5d"}')
    read = read_files(spark, FEEDS["online_orders"], path)
    assert sorted(r.order_id for r in read.collect()) == sorted([*as_written, "1.5d"])


def test_columns_of_a_table_are_listed_without_a_job(spark, lake):
    context = spark.sparkContext
    group = uuid.uuid4().hex
    context.setJobGroup(group, "listing")
    try:
        assert partition_columns(spark, lake.fact) == ["job_date"]
        assert partition_columns(spark, lake.bronze("pos_transactions")) == ["_job_date", "_batch_id"]
        assert partition_columns(spark, lake.bronze("product_master")) == []
        assert not context.statusTracker().getJobIdsForGroup(group)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_rows_of_one_day_are_not_sorted_by_it(spark, lake, monkeypatch):
    plans, open_files = [], []

    def aligned(df, table, before=sinks._aligned):
        open_files.append(int(spark.conf.get(sinks.OPEN_FILES)))
        rows = before(df, table)
        rows.createOrReplaceTempView("to_write")
        plans.append(spark.sql(f"EXPLAIN INSERT OVERWRITE TABLE {table} SELECT * FROM to_write").first()[0])
        return rows

    monkeypatch.setattr(sinks, "_aligned", aligned)
    rows = spark.range(0, 90, 1, 3).selectExpr("id AS bucket", "CAST(NULL AS BINARY) AS bits", "'d1' AS job_date")
    assert replace_day(rows, lake.sale_ids, "job_date", "d1") == 90
    totals = spark.range(0, 90, 1, 3).selectExpr("'daily' AS family", "id AS bucket", "CAST(id % 8 AS INT) AS part")
    replace_partitions(totals, lake.gold_totals, at_most=8)
    assert len(plans) == 2 and not any("Sort" in plan for plan in plans)
    # With as many as there are, all rows after the first of the last partition would be sorted.
    assert open_files[0] > 1 and open_files[1] > 8
    assert spark.table(lake.gold_totals).where("part = bucket % 8").count() == 90
    # More than was said are written all the same, and without the word for it rows are sorted.
    replace_partitions(totals, lake.gold_totals, at_most=2)
    assert spark.table(lake.gold_totals).where("part = bucket % 8").count() == 90
    replace_partitions(totals, lake.gold_totals)
    assert "Sort" in plans[-1]
    assert spark.conf.get(sinks.OPEN_FILES) == "0" and spark.conf.get(sinks.OVERWRITE).lower() == "static"


def test_files_of_sales_are_compact(spark, lake, tmp_path):
    rows = spark.range(0, 9, 1, 1).selectExpr("'x' AS transaction_id", "'d1' AS job_date")
    for table in (lake.fact, lake.rejects):
        replace_day(rows, table, "job_date", "d1")
        assert all(name.endswith(".zstd.parquet") for name in spark.table(table).inputFiles())
    assert sinks.written(rows, str(tmp_path / "rows"), sinks.COMPACT).inputFiles()[0].endswith(".zstd.parquet")
