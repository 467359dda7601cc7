import random
from collections import Counter
from datetime import datetime

from conftest import pos, rows, sale

from tillflow.operators import masters as M
from tillflow.operators import rejects as R
from tillflow.operators.audit import audit_row, batch_counts, recent_runs
from tillflow.operators.quality import (
    field_checks,
    issue_summary,
    one_per_key,
    orphan_counts,
    orphans,
    quality_report,
)
from tillflow.operators.rejects import (
    accepted_sales,
    reject_records,
    rejected_rows,
    repeat_rows,
    repeated_ids,
    typed_clean_sales,
)
from tillflow.sinks.tables import written

AS_OF = datetime(2026, 7, 11)


def reasons(spark, *lines):
    found = rejected_rows(pos(spark, *lines), AS_OF).collect()
    return {row.transaction_id: row.reasons for row in found}


def test_each_rule(spark):
    found = reasons(
        spark,
        sale("ok"),
        sale(None),
        sale("product", product=None),
        sale("null text", product=" Null "),
        sale("zero", quantity="0"),
        sale("minus", quantity="-1"),
        sale("price", price="-0.01"),
        sale("free", price="0"),
        sale("future", time="2026-07-11 00:00:01"),
        sale("now", time="2026-07-11 00:00:00"),
        sale("guest", customer=None),
        sale("no discount", discount=None),
        sale("store", store=None),
        sale("no quantity", quantity=None),
        sale("words", quantity="abc", price="x", time="2026-13-01"),
        sale("no time", time=None),
    )
    assert found == {
        None: ["R1_ID_MISSING"],
        "product": ["R2_PRODUCT_MISSING"],
        "null text": ["R2_PRODUCT_MISSING"],
        "zero": ["R3_QUANTITY_NOT_POSITIVE"],
        "minus": ["R3_QUANTITY_NOT_POSITIVE"],
        "price": ["R4_PRICE_NEGATIVE"],
        "future": ["R5_TIME_IN_FUTURE"],
        "store": ["R7_STORE_MISSING"],
        "no quantity": ["R8_QUANTITY_MISSING"],
        "words": ["R11_QUANTITY_UNREADABLE", "R12_PRICE_UNREADABLE", "R13_TIME_UNREADABLE"],
        "no time": ["R10_TIME_MISSING"],
    }


def test_best_copy_stays(spark):
    lines = [
        sale("d", time="2026-07-10 09:00:00", quantity="0"),
        sale("d", time="2026-07-10 11:00:00"),
        sale("d", time="2026-07-10 10:00:00", price="2"),
    ]
    kept = accepted_sales(pos(spark, *lines), AS_OF).collect()
    assert [str(row.transaction_time) for row in kept] == ["2026-07-10 10:00:00"]
    bad = rejected_rows(pos(spark, *lines), AS_OF).collect()
    assert sorted(row.reasons for row in bad) == [
        ["R3_QUANTITY_NOT_POSITIVE", "R6_DUPLICATE_ID"], ["R6_DUPLICATE_ID"],
    ]


def test_all_copies_faulty(spark):
    lines = [sale("d", quantity="0"), sale("d", quantity="0"), sale("d", quantity="-1")]
    assert accepted_sales(pos(spark, *lines), AS_OF).isEmpty()
    bad = rejected_rows(pos(spark, *lines), AS_OF).collect()
    assert Counter(tuple(row.reasons) for row in bad) == {
        ("R3_QUANTITY_NOT_POSITIVE",): 1,
        ("R3_QUANTITY_NOT_POSITIVE", "R6_DUPLICATE_ID"): 2,
    }


def test_every_row_ends_in_one_side_with_one_id_holding_a_third(spark, tmp_path, monkeypatch):
    draw = random.Random(7)
    lines = [sale("hot", price="5")] * 400
    lines += [sale("hot", price=str(draw.randint(1, 50))) for _ in range(100)]
    for _ in range(1000):
        lines.append(
            sale(
                draw.choice([None, " null", f"t{draw.randint(1, 400)}"]),
                customer=draw.choice([None, "c1"]),
                quantity=draw.choice(["1", "2", "0", "x", None]),
                price=draw.choice(["1", "-1", "2.50"]),
                time=draw.choice(["2026-07-10 01:00:00", "2027-01-01 00:00:00", None]),
            )
        )
    bronze = pos(spark, *lines)
    accepted = accepted_sales(bronze, AS_OF).collect()
    rejected = rejected_rows(bronze, AS_OF)
    listed = written(repeated_ids(bronze), str(tmp_path / "ids"))
    assert rows(accepted_sales(bronze, AS_OF, listed)) == rows(accepted_sales(bronze, AS_OF))
    settled = rejected_rows(
        bronze, AS_OF, listed, lambda df: written(df, str(tmp_path / "suspects"))
    )
    assert rows(settled) == rows(rejected)
    monkeypatch.setattr(M, "fits_broadcast", lambda *_: False)
    assert rows(rejected_rows(bronze, AS_OF, listed)) == rows(settled)
    bad = [tuple(row)[:8] for row in rejected.collect()]
    assert len(accepted) + len(bad) == len(lines)
    assert not Counter(bad) - Counter(lines)
    left = Counter(lines) - Counter(bad)
    assert sum(left.values()) == len(accepted)
    assert {line[0] for line in left} == {row.transaction_id for row in accepted}
    assert len({row.transaction_id for row in accepted}) == len(accepted)

    def value(line):
        return (line[7], *[x or "" for x in line])

    usable = {}
    for line in lines:
        ok = (
            line[0] and line[0].strip().upper() != "NULL" and line[4] in ("1", "2")
            and not line[5].startswith("-") and line[7] and line[7] < "2026-07-11"
        )
        if ok:
            usable.setdefault(line[0], []).append(line)
    assert usable.keys() == {line[0] for line in left}
    assert all(line[7] == min(map(value, usable[line[0]]))[0] for line in left)


def test_copies_are_written_in_bounded_parts(spark):
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 10)], "k STRING, n BIGINT")
    repeated = repeat_rows(df, "n", per_task=10)
    assert Counter(row.k for row in repeated.collect()) == {"a": 25, "b": 1, "c": 10}


def test_reject_records(spark):
    bad = rejected_rows(pos(spark, sale("x", quantity="abc"), sale("y", product=None)), AS_OF)
    records = {
        row.transaction_id: row
        for row in reject_records(bad, "b1", "2026-07-10", "tills", AS_OF).collect()
    }
    assert records["x"].error_code == "E003"
    assert records["x"].rejection_category == "INVALID_FORMAT"
    assert '"quantity":"abc"' in records["x"].raw_data
    assert records["y"].error_code == "E004"
    assert records["y"].rejection_reason == "product_id is missing"
    assert '"product_id":null' in records["y"].raw_data
    assert records["y"].rejected_timestamp == AS_OF


def masters(spark):
    def frame(key, *values):
        return spark.createDataFrame([(v,) for v in values], f"{key} STRING")

    products = spark.createDataFrame(
        [("p1", "g1"), ("p2", "gone"), ("p3", None)], "product_id STRING, category_id STRING"
    )
    return {
        "product_master": products,
        "customer_master": frame("customer_id", "c1"),
        "store_master": frame("store_id", "s1"),
        "category_master": frame("category_id", "g1"),
    }


def test_quality_report(spark):
    sales = typed_clean_sales(
        pos(
            spark,
            sale("a"), sale("a"), sale(None), sale(None, product=None),
            sale("b", customer=None, product="p9", quantity="-2"),
            sale("c", customer="c9", store="s9", price=None),
            sale("d", product="p9"),
        )
    )
    found = {(r.check, r.field): r.failed_rows for r in quality_report(sales, masters(spark)).collect()}
    assert found == {
        ("total", "*"): 7,
        ("duplicate", "transaction_id"): 2,
        ("null", "transaction_id"): 2,
        ("null", "product_id"): 1,
        ("null", "store_id"): 0,
        ("null", "quantity"): 0,
        ("null", "unit_price"): 1,
        ("negative", "quantity"): 1,
        ("negative", "unit_price"): 0,
        ("orphan", "product_id"): 2,  # p9 and the missing one
        ("orphan", "customer_id"): 1,
        ("orphan", "store_id"): 1,
        ("orphan", "category_id"): 2,
    }
    summary = issue_summary(quality_report(sales, masters(spark))).first()
    # Nine of the counts above, the total left aside, are not zero.
    assert tuple(summary) == (7, 2, 5, 9)


def test_checks_on_no_rows(spark):
    sales = typed_clean_sales(pos(spark, sale())).where("false")
    assert {row.failed_rows for row in field_checks(sales).collect()} == {0}
    assert {row.failed_rows for row in orphan_counts(sales, {"store_master": masters(spark)["store_master"]}).collect()} == {0}


def test_orphans_count_a_missing_key_once(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",), ("s1",)], "store_id STRING")
    known = masters(spark)["store_master"]
    assert rows(orphans(df, known, "store_id")) == [("x",), (None,)]
    assert rows(orphans(df, known, "store_id", skip_null=True)) == [("x",)]


def test_one_per_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 4), (None, 3)], "k STRING, v INT")
    assert rows(one_per_key(df, "k")) == sorted([("a", 1), (None, 3)], key=repr)


def test_audit(spark):
    ok = spark.createDataFrame([("b1",), ("b1",), ("b2",)], "batch_id STRING")
    bad = spark.createDataFrame([("b1",), ("b3",)], "batch_id STRING")
    counts = batch_counts(ok, bad)
    assert rows(counts) == [("b1", 3, 2, 1), ("b2", 1, 1, 0), ("b3", 1, 0, 1)]
    start, end = datetime(2026, 7, 10, 1), datetime(2026, 7, 10, 1, 1, 30)
    log = audit_row(counts, "2026-07-10", "daily_sales", "dev", start, end)
    assert {row.status for row in log.collect()} == {"SUCCESS"}
    assert log.first().execution_duration_seconds == 90.0
    none = counts.selectExpr("batch_id", "0L records_read", "0L records_processed", "0L records_rejected")
    assert audit_row(none, "d", "j", "e", start, end).first().status == "FAILED"
    assert recent_runs(log, 2).count() == 2


def test_ids_with_their_numbers_are_shuffled_once(spark, tmp_path, monkeypatch):
    draw = random.Random(11)
    lines = [sale("hot", price=str(draw.randint(1, 9))) for _ in range(60)] + [sale("hot", quantity="0")] * 5
    for _ in range(600):
        lines.append(sale(
            draw.choice([None, " ", f"t{draw.randint(1, 150)}"]), customer=draw.choice([None, "c1", " c1"]),
            quantity=draw.choice(["1", " 1", "0", "x", None]), price=draw.choice(["1", "1.00", "-1"]),
            time=draw.choice(["2026-07-10 01:00:00", "2027-01-01 00:00:00", None])))
    bronze = written(pos(spark, *lines), str(tmp_path / "bronze"))
    known = spark.createDataFrame([("t1",), ("t2",), ("hot",)], "_id STRING")
    plain = written(repeated_ids(bronze), str(tmp_path / "ids"))
    counted = written(repeated_ids(bronze, counted=True), str(tmp_path / "counted"))

    def found(listed):
        return rejected_rows(bronze, AS_OF, listed, known=known)

    # Ids of more rows than a task may have are counted as before.
    for bound in (100_000, 20, 1):
        monkeypatch.setattr(R, "COPIES_PER_TASK", bound)
        assert rows(found(counted)) == rows(found(plain)), bound
    suspects = bronze.selectExpr("*", "transaction_id AS _id", "true AS _usable", "false AS _known")
    plan = R._rejected_by_rank(suspects, [*bronze.columns, "_known"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "_w0" not in plan.split("Exchange")[1]


def test_a_day_ranked_by_id_gives_the_same_sides(spark, tmp_path, monkeypatch):
    lines = [sale(f"t{n % 40}" if n % 7 else None, quantity=["2", " 2 ", "abc", None, "0"][n % 5], price=["9.50", "null"][n % 11 == 0],
                  customer=["c1", " NULL", ""][n % 3]) for n in range(300)]
    lines += [sale("hot", quantity=["1", "x"][n % 2], store=f"s{n % 3}") for n in range(60)] + [sale(None)] * 5
    bronze = pos(spark, *lines).repartition(6)
    known = spark.createDataFrame([("t3",), ("hot",), ("none",)], "_id STRING")
    numbers = iter(range(100))

    def settle(df):
        return written(df, f"{tmp_path}/{next(numbers)}")

    listed = settle(repeated_ids(bronze, counted=True))
    # Ids of more than the limit, one for the second, are counted and do not come together.
    for most in (100_000, 50):
        monkeypatch.setattr(R, "COPIES_PER_TASK", most)
        ranked = settle(R.ranked_rows(bronze, AS_OF, listed, settle))
        assert ranked.count() == len(lines)
        assert rows(R.accepted_ranked(ranked)) == rows(accepted_sales(bronze, AS_OF))
        for barred in (None, known):
            assert rows(R.rejected_ranked(ranked, AS_OF, barred)) == rows(rejected_rows(bronze, AS_OF, known=barred))


def test_a_day_ranked_by_id_shuffles_its_rows_once(spark, tmp_path):
    bronze = pos(spark, sale("a"), sale("a"), sale("b"), sale(None))
    listed = written(repeated_ids(bronze, counted=True), f"{tmp_path}/listed")
    plan = R.ranked_rows(bronze, AS_OF, listed, lambda df: written(df, f"{tmp_path}/many"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
