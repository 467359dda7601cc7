"""Accepted and rejected sales.

Every bronze row ends in exactly one of the two. A row is rejected for all its
reasons at once; of several rows with one transaction id the best stays: rows
without another fault first, then the earliest, then the least by all values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.lineage import moment, moment_sql
from tillflow.functions.text import without_null_text
from tillflow.operators.masters import attach, fits_broadcast
from tillflow.schemas import FEED_COLUMNS, SALES_TYPES

# Rule, category and wording, in order of precedence.
DUPLICATE = "R6_DUPLICATE_ID"
RULES = {
    "R1_ID_MISSING": ("NULL_VALUE", "transaction_id is missing"),
    "R2_PRODUCT_MISSING": ("NULL_VALUE", "product_id is missing"),
    "R3_QUANTITY_NOT_POSITIVE": ("INVALID_VALUE", "quantity is zero or less"),
    "R4_PRICE_NEGATIVE": ("INVALID_VALUE", "unit_price is negative"),
    "R5_TIME_IN_FUTURE": ("INVALID_VALUE", "transaction_time is in the future"),
    DUPLICATE: ("DUPLICATE", "transaction_id occurs more than once"),
    "R7_STORE_MISSING": ("NULL_VALUE", "store_id is missing"),
    "R8_QUANTITY_MISSING": ("NULL_VALUE", "quantity is missing"),
    "R9_PRICE_MISSING": ("NULL_VALUE", "unit_price is missing"),
    "R10_TIME_MISSING": ("NULL_VALUE", "transaction_time is missing"),
    "R11_QUANTITY_UNREADABLE": ("INVALID_FORMAT", "quantity is not a whole number"),
    "R12_PRICE_UNREADABLE": ("INVALID_FORMAT", "unit_price is not an amount"),
    "R13_TIME_UNREADABLE": ("INVALID_FORMAT", "transaction_time is not a timestamp"),
    "R14_ID_OF_ANOTHER_DAY": ("DUPLICATE", "transaction_id was accepted on another day"),
}
# Most rows one task writes for one group of identical copies.
COPIES_PER_TASK = 100_000

RAW = FEED_COLUMNS["pos_transactions"]
# Which of several usable copies of a sale stays.
ORDER = ["transaction_time", *[name for name in RAW if name != "transaction_time"]]


def _value(name: str) -> str:
    """SQL for a raw column cleansed and in its type."""
    text, kind = without_null_text(name), SALES_TYPES[name]
    return text if kind == "string" else f"try_cast({text} AS {kind})"


# SQL for the raw columns in their types, and for those that tell rows without an id apart.
VALUES = ", ".join(f"{_value(name)} AS {name}" for name in RAW)
OTHERS = ", ".join(name for name in RAW if name != "transaction_id")


def usable(as_of: datetime, of: str = "") -> str:
    """SQL over typed sales: no fault, leaving repeated ids aside."""
    return (
        f"coalesce({of}transaction_id IS NOT NULL AND {of}product_id IS NOT NULL"
        f" AND {of}store_id IS NOT NULL AND {of}quantity > 0 AND {of}unit_price >= 0"
        f" AND {of}transaction_time <= {moment_sql(as_of)}, false)"
    )


def _faults(as_of: datetime) -> dict[str, str]:
    """SQL per rule over raw columns and their typed values, ``v.<name>``."""
    return {
        "R1_ID_MISSING": "v.transaction_id IS NULL",
        "R2_PRODUCT_MISSING": "v.product_id IS NULL",
        "R3_QUANTITY_NOT_POSITIVE": "v.quantity <= 0",
        "R4_PRICE_NEGATIVE": "v.unit_price < 0",
        "R5_TIME_IN_FUTURE": f"v.transaction_time > {moment_sql(as_of)}",
        DUPLICATE: "_extra",
        "R7_STORE_MISSING": "v.store_id IS NULL",
        "R8_QUANTITY_MISSING": _lacks("quantity"),
        "R9_PRICE_MISSING": _lacks("unit_price"),
        "R10_TIME_MISSING": _lacks("transaction_time"),
        "R11_QUANTITY_UNREADABLE": f"v.quantity IS NULL AND NOT ({_lacks('quantity')})",
        "R12_PRICE_UNREADABLE": f"v.unit_price IS NULL AND NOT ({_lacks('unit_price')})",
        "R13_TIME_UNREADABLE": (
            f"v.transaction_time IS NULL AND NOT ({_lacks('transaction_time')})"
        ),
        "R14_ID_OF_ANOTHER_DAY": "_known",
    }


def _lacks(name: str) -> str:
    return f"{without_null_text(name)} IS NULL"


def typed_clean_sales(bronze: DataFrame, *others: str) -> DataFrame:
    """The sale columns of bronze cleansed and in their types, and the columns ``others`` as they are."""
    return bronze.selectExpr(*[f"{_value(name)} AS {name}" for name in RAW], *others)


def repeated_ids(bronze: DataFrame, counted: bool = False) -> DataFrame:
    """The transaction ids, as ``_id``, that more than one row has; ``counted`` adds how many, as ``_n``.

    Only ids are shuffled, combined beforehand.
    """
    ids = bronze.selectExpr(f"{_value('transaction_id')} AS _id").where("_id IS NOT NULL")
    found = ids.groupBy("_id").agg(F.count("*").alias("_n")).where("_n > 1")
    return found if counted else found.select("_id")


def _flag_repeated(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows with an ``_id``, ``_repeats`` telling whether it is a repeated one, and ``_n`` if the list has it.

    A long list is joined by shuffle, rows without an id spread by their other
    values. Adaptive execution divides the partition of an id with very many
    rows, as it may for the larger side of a left join.
    """
    counts = {"_n": "_n"} if "_n" in repeated.columns else {}
    return attach(rows, repeated, "_id", counts, spread_by=OTHERS, found="_repeats")


def accepted_sales(
    bronze: DataFrame, as_of: datetime, repeated: DataFrame | None = None
) -> DataFrame:
    """The sales without fault, typed, one per transaction id.

    ``repeated``, the written result of ``repeated_ids``, saves the shuffle of
    all rows when it is small enough to broadcast: then only rows of repeated
    ids are grouped. Without it, or beyond that size, all rows are.
    """
    faulty = f"NOT {usable(as_of)}"
    sales = typed_clean_sales(bronze)
    if repeated is None or not fits_broadcast(repeated):
        return _one_per_id(sales, faulty)
    flagged = _flag_repeated(sales.selectExpr("*", "transaction_id AS _id"), repeated)
    # As one condition over both sides of the join, it is judged once, after it.
    fit = f"CASE WHEN _repeats THEN false ELSE NOT {faulty} END"
    single = flagged.where(fit).select(*RAW)
    return single.unionByName(_one_per_id(flagged.where("_repeats").select(*RAW), faulty))


def _one_per_id(sales: DataFrame, faulty: str) -> DataFrame:
    """The usable sale of each id that has one.

    Copies combine before the shuffle, so an id with very many of them costs one
    row per map task. All values are in the order: copies that tie are the same
    sale. Faults are part of the order and filtered afterwards, so that the
    values are read from the text once; pushed below the typing, the filter
    would read them all again.
    """
    row = f"struct({faulty} AS _faulty, {', '.join(ORDER)}) AS _row"
    return (
        sales.selectExpr("transaction_id AS _id", row)
        .where("_id IS NOT NULL")
        .groupBy("_id")
        .agg(F.min("_row").alias("_kept"))
        .where("NOT _kept._faulty")
        .selectExpr(*[f"_kept.{name}" for name in RAW])
    )


def rejected_rows(
    bronze: DataFrame,
    as_of: datetime,
    repeated: DataFrame | None = None,
    settle: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    known: DataFrame | None = None,
) -> DataFrame:
    """The bronze rows with a fault or a repeated id, with ``reasons``.

    ``known`` lists, as ``_id``, the ids accepted on other days: every row of theirs has a fault.

    ``repeated`` is the result of ``repeated_ids``; written to a table first, its
    size is known and it is broadcast when small, so that only the rows in
    question are shuffled, and shuffled once if it has their numbers (see ``repeated_ids``).
    These are read several times: ``settle``, which writes them to a table, saves more
    passes over the bronze rows.
    """
    columns = bronze.columns
    judged = bronze.selectExpr("*", f"struct({VALUES}) AS v").selectExpr(
        *columns, "v.transaction_id AS _id", f"{usable(as_of, 'v.')} AS _usable"
    )
    judged = _flag_known(judged, known)
    listed = repeated_ids(bronze) if repeated is None else repeated
    counts = [name for name in ("_n",) if name in listed.columns]
    suspects = settle(
        _flag_repeated(judged, listed)
        .where("_repeats OR _known OR NOT _usable")
        .select(*columns, "_id", "_usable", "_repeats", "_known", *counts)
    )
    single = suspects.where("NOT _repeats").selectExpr(*columns, "_known", "false AS _extra")
    copies = suspects.where("_repeats")
    if counts:
        few, many = copies.where(f"_n <= {COPIES_PER_TASK}"), copies.where(f"_n > {COPIES_PER_TASK}")
        rejected = single.unionByName(_rejected_by_rank(few, [*columns, "_known"])).unionByName(
            _rejected_copies(many, [*columns, "_known"]))
    else:
        rejected = single.unionByName(_rejected_copies(copies, [*columns, "_known"]))
    return _with_reasons(rejected, as_of, columns)


def _flag_known(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Rows with an ``_id``, ``_known`` telling whether ``known`` lists it."""
    if known is None:
        return rows.withColumn("_known", F.lit(False))
    return attach(rows, known, "_id", {}, spread_by=OTHERS, found="_known")


def _with_reasons(rejected: DataFrame, as_of: datetime, columns: list[str]) -> DataFrame:
    cases = [f"CASE WHEN {rule} THEN '{name}' END" for name, rule in _faults(as_of).items()]
    return rejected.selectExpr("*", f"struct({VALUES}) AS v").selectExpr(
        *columns, f"array_compact(array({', '.join(cases)})) AS reasons"
    )


def ranked_rows(
    bronze: DataFrame,
    as_of: datetime,
    repeated: DataFrame,
    settle: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """All bronze rows, ``_usable`` telling those without fault and ``_extra`` those of whose id another row stays.

    For days of very many repeated ids: all rows are shuffled by their id, once, and what is accepted
    and rejected is read from the result (see ``accepted_ranked`` and ``rejected_ranked``). Write it to a
    table first. ``repeated`` is the written result of ``repeated_ids`` with numbers; rows of
    ids with more than ``COPIES_PER_TASK`` do not come together but are counted.
    """
    columns = bronze.columns
    rows = bronze.selectExpr("*", f"{_value('transaction_id')} AS _id")
    # At most one for each ``COPIES_PER_TASK`` rows.
    many = settle(repeated.where(f"_n > {COPIES_PER_TASK}").select("_id"))
    crowded = None
    if not many.isEmpty():
        rows = attach(rows, many, "_id", {}, spread_by=OTHERS, found="_many")
        crowded = rows.where("_many").selectExpr("*", f"struct({VALUES}) AS v").selectExpr(
            *columns, "_id", f"{usable(as_of, 'v.')} AS _usable")
        rows = rows.where("NOT _many")
    # Rows without an id are no copies of each other, and are spread by their other values.
    alone = f"CASE WHEN _id IS NULL THEN xxhash64({OTHERS}) END AS _alone"
    gathered = rows.selectExpr(*columns, "_id", alone).repartition("_id", "_alone").selectExpr(
        "*", f"struct({VALUES}) AS v").selectExpr(
        *columns, "_id", "_alone", f"{usable(as_of, 'v.')} AS _usable")
    order = [expression.rsplit(" AS ", 1)[0] for expression in _copy_order(columns)]
    turn = f"row_number() OVER (PARTITION BY _id, _alone ORDER BY {', '.join(order)}) AS _turn"
    ranked = gathered.selectExpr("*", turn).selectExpr(
        *columns, "_usable", "_id IS NOT NULL AND _turn > 1 AS _extra")
    if crowded is None:
        return ranked
    counted = _counted_copies(crowded, columns, "1L").selectExpr("*", f"struct({VALUES}) AS v")
    return ranked.unionByName(counted.selectExpr(*columns, f"{usable(as_of, 'v.')} AS _usable", "_extra"))


def accepted_ranked(ranked: DataFrame) -> DataFrame:
    """As ``accepted_sales``, from ``ranked_rows``."""
    return typed_clean_sales(ranked.where("_usable AND NOT _extra"))


def rejected_ranked(ranked: DataFrame, as_of: datetime, known: DataFrame | None = None) -> DataFrame:
    """As ``rejected_rows``, from ``ranked_rows``."""
    columns = [name for name in ranked.columns if name not in ("_usable", "_extra")]
    rows = _flag_known(ranked.selectExpr("*", f"{_value('transaction_id')} AS _id"), known)
    return _with_reasons(rows.where("NOT _usable OR _extra OR _known"), as_of, columns)


def _copy_order(columns: list[str]) -> list[str]:
    """SQL of the values by which the least of the rows with one id is kept."""
    return ["NOT _usable AS _faulty", *[f"{_value(name)} AS _{name}" for name in ORDER], *[f"`{name}`" for name in columns]]


def _rejected_by_rank(copies: DataFrame, columns: list[str]) -> DataFrame:
    """As ``_rejected_copies``, for ids of a bounded number of rows: these come together once, in one task."""
    order = [expression.rsplit(" AS ", 1)[0] for expression in _copy_order(columns)]
    # Repartitioned first, so that what the order is by is worked out after the shuffle.
    gathered = copies.select(*columns, "_id", "_usable").repartition("_id")
    first = f"row_number() OVER (PARTITION BY _id ORDER BY {', '.join(order)}) = 1 AS _first"
    return gathered.selectExpr("*", first).where("NOT _first OR NOT _usable OR _known").selectExpr(
        *columns, "NOT _first AS _extra")


def _rejected_copies(copies: DataFrame, columns: list[str]) -> DataFrame:
    """Of rows with repeated ids: all but the kept ones, and kept ones with a fault.

    ``_extra`` tells surplus copies from kept ones.
    """
    return _counted_copies(copies, columns, "if(_kept._faulty OR _kept._known, 1L, 0L)")


def _counted_copies(copies: DataFrame, columns: list[str], kept_times: str) -> DataFrame:
    """Rows with repeated ids: surplus copies, ``_extra``, and the kept one ``kept_times`` times.

    Equal copies are counted and the kept one is counted off. The rest is
    written out in parts of bounded size, so no task holds all copies of an id.
    """
    row = ", ".join(_copy_order(columns))
    kept = (
        copies.selectExpr("_id", f"struct({row}) AS _row")
        .groupBy("_id")
        .agg(F.min("_row").alias("_kept"))
        .selectExpr(
            *[f"_kept.`{name}`" for name in columns],
            "-1L AS _surplus", f"{kept_times} AS _faulty",
        )
    )
    counted = (
        copies.selectExpr(*columns, "1L AS _surplus", "0L AS _faulty")
        .unionByName(kept)
        .groupBy(*columns)
        .agg(F.sum("_surplus").alias("_surplus"), F.sum("_faulty").alias("_faulty"))
    )
    kinds = (
        "inline(array(struct(true AS _extra, _surplus AS _n),"
        " struct(false AS _extra, _faulty AS _n)))"
    )
    return repeat_rows(counted.selectExpr(*columns, kinds).where("_n > 0"), "_n")


def repeat_rows(df: DataFrame, times: str, per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Each row ``times`` times, large numbers divided among tasks."""
    columns = [name for name in df.columns if name != times]
    part = f"explode(sequence(0L, ({times} - 1) DIV {per_task})) AS _part"
    share = f"explode(sequence(1L, least({per_task}L, {times} - _part * {per_task}L))) AS _copy"
    parts = df.selectExpr("*", part)
    spread = parts.repartition(F.expr(f"xxhash64({', '.join(columns)})"), F.col("_part"))
    return spread.selectExpr(*columns, share).drop("_copy")


def reject_records(
    rejected: DataFrame,
    batch_id: str,
    job_date: str,
    source_system: str,
    at: datetime | None = None,
) -> DataFrame:
    """Rows of the reject table: the raw row as JSON and why it was rejected.

    Text that does not fit its type is E003, any other quality fault E004.
    """
    category = " ".join(f"WHEN '{r}' THEN '{kind}'" for r, (kind, _) in RULES.items())
    wording = " ".join(f"WHEN '{r}' THEN '{text}'" for r, (_, text) in RULES.items())
    source = "_source_file" if "_source_file" in rejected.columns else "CAST(NULL AS STRING)"
    return rejected.selectExpr(
        f"{_value('transaction_id')} AS transaction_id",
        f"to_json(struct({', '.join(RAW)}), map('ignoreNullFields', 'false')) AS raw_data",
        f"CASE reasons[0] {wording} END AS rejection_reason",
        f"CASE reasons[0] {category} END AS rejection_category",
        "reasons",
        f"{source} AS source_file",
    ).withColumns(
        {
            "error_code": F.expr(
                "if(rejection_category = 'INVALID_FORMAT', 'E003', 'E004')"
            ),
            "batch_id": F.lit(batch_id),
            "rejected_timestamp": moment(at),
            "source_system": F.lit(source_system),
            "job_date": F.lit(job_date),
        }
    )
