"""Bronze to the sales fact and its rejects."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.lineage import add_audit
from tillflow.functions.sales import conform_amounts, derive_sales
from tillflow.functions.text import cleanse, standardise
from tillflow.functions.typing import typed_master
from tillflow.operators.batches import batch_of_day
from tillflow.operators.enrich import enrich
from tillflow.operators.known_ids import id_filter, known_ids, without_known
from tillflow.operators.masters import current_rows, fits_broadcast, hot_keys
from tillflow.operators.rejects import (
    RAW,
    accepted_ranked,
    accepted_sales,
    ranked_rows,
    reject_records,
    rejected_ranked,
    rejected_rows,
    repeated_ids,
    typed_clean_sales,
)
from tillflow.plans.layers import Lake
from tillflow.schemas import FACT_SALES, MASTER_KEYS, MASTER_TYPES
from tillflow.session import temporary_workspace
from tillflow.sinks.tables import COMPACT, append, replace_day, with_retry, written
from tillflow.sources.feeds import FeedError
from tillflow.sources.tables import fitted_shuffles, rows_of

SOURCE_SYSTEM = "tillflow"


class DayCounts(NamedTuple):
    """Rows of one day: read from bronze, accepted into the fact, rejected."""

    read: int
    accepted: int
    rejected: int


def prepare_masters(
    bronze: Mapping[str, DataFrame], unique: bool = False
) -> dict[str, DataFrame]:
    """Typed, cleansed masters with one row per key, the latest landed.

    ``unique`` says that no key repeats in any of them, which saves the check.
    """
    prepared = {}
    for name, rows in bronze.items():
        stamp = [c for c in ("_ingestion_timestamp",) if c in rows.columns and not unique]
        master = cleanse(typed_master(rows, name, stamp))
        if not unique:
            # Keys are compared as cleansed, and only the columns in use are moved.
            master = current_rows(master, MASTER_KEYS[name], stamp).drop(*stamp)
        prepared[name] = master
    return prepared


def enriched_sales(
    typed: DataFrame,
    masters: Mapping[str, DataFrame],
    hot: Mapping[str, DataFrame] | None = None,
    sizes: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Typed sales with dates, money and master attributes.

    Dates and money are worked out after the joins that need none of them, which may shuffle the sales.
    """
    dated = {name: rows for name, rows in masters.items() if name == "retail_calendar"}
    others = {name: rows for name, rows in masters.items() if name not in dated}
    named = enrich(typed, others, hot, sizes)
    derived = enrich(derive_sales(named), dated, hot, sizes)
    # In the order of the steps: sales, dates and money, masters, warnings.
    last = [name for name in named.columns if name not in typed.columns and name != "missing_masters"]
    warnings = [name for name in named.columns if name == "missing_masters"]
    worked_out = [name for name in derive_sales(typed).columns if name not in typed.columns]
    rest = [name for name in derived.columns if name not in {*named.columns, *worked_out}]
    return conform_amounts(derived.select(*typed.columns, *worked_out, *last, *rest, *warnings))


def fact_rows(
    enriched: DataFrame,
    batch_id: str,
    job_date: str,
    source_system: str = SOURCE_SYSTEM,
    at: datetime | None = None,
) -> DataFrame:
    """Enriched sales in upper-case text with run columns, in the fact's order.

    The month and the warnings are codes, not descriptions, and stay as they are.
    """
    upper = standardise(enriched, skip=("year_month",))
    rows = add_audit(upper, batch_id, job_date, source_system, at)
    names = [f.name for f in FACT_SALES.fields if f.name in rows.columns]
    return rows.select(*names)


def build_silver(
    spark: SparkSession,
    lake: Lake,
    job_date: str,
    batch_id: str,
    as_of: datetime,
    source_system: str = SOURCE_SYSTEM,
    at: datetime | None = None,
) -> DayCounts:
    """Write one day's accepted and rejected sales; returns the day's row counts.

    Both overwrite the day's partition, so the latest run of a day stands. A day
    that bronze has no rows of is an E002 error, before anything is written, and
    a run that accepts and rejects other than what it read is an E005 error. An id
    accepted on another day is rejected: filters of the ids of each day tell which
    days, if any, have to be read for that. The day's own filter is written before
    its fact, so at worst it names ids that are not there. Keys
    that fill more than one task are looked up in the bronze day, and only for
    masters too large to broadcast.
    """
    day = rows_of(spark, lake.bronze("pos_transactions"), _job_date=job_date)
    batch = batch_of_day(day, batch_id)
    if batch is None:
        raise FeedError("E002", f"pos_transactions: no rows landed for {job_date}")
    sales = day.where(F.col("_batch_id") == batch)
    tables = {name: spark.table(lake.bronze(name)) for name in MASTER_TYPES}
    with fitted_shuffles(spark, day), temporary_workspace(spark, "silver") as settle_folder:
        def settle(rows: DataFrame) -> DataFrame:
            return written(rows, settle_folder())

        def settle_sales(rows: DataFrame) -> DataFrame:
            return written(rows, settle_folder(), COMPACT)

        hot = {
            name: settle(hot_keys(typed_clean_sales(sales), key))
            for name, key in MASTER_KEYS.items()
            if key in sales.columns and not fits_broadcast(tables[name])
        }
        repeated = settle(repeated_ids(sales, counted=True))
        # A reject names its file; what else bronze adds is the same in all rows of a batch, or not kept.
        raw = sales.select(*RAW, "_source_file")
        # Few repeated ids are looked up, and only their rows shuffled; of many, all rows are.
        ranked = None if fits_broadcast(repeated) else settle_sales(ranked_rows(raw, as_of, repeated, settle))
        accepted = settle_sales(accepted_sales(sales, as_of, repeated)) if ranked is None else accepted_ranked(ranked)
        other_day = F.col("job_date") != job_date
        known = settle(known_ids(
            accepted.selectExpr("transaction_id AS _id"), spark.table(lake.sale_ids).where(other_day),
            spark.table(lake.fact).where(other_day), settle))
        accepted = without_known(accepted, known)
        enriched = enriched_sales(accepted, prepare_masters(tables), hot, tables)
        fact = fact_rows(enriched, batch_id, job_date, source_system, at)
        # The joins neither drop a sale nor change its id.
        filters = id_filter(accepted.select("transaction_id")).withColumn("job_date", F.lit(job_date))
        replace_day(filters, lake.sale_ids, "job_date", job_date)
        bad = (rejected_rows(raw, as_of, repeated, settle_sales, known) if ranked is None
               else rejected_ranked(ranked, as_of, known))
        bad = reject_records(bad, batch_id, job_date, source_system, at)
        counts = DayCounts(
            sales.count(),
            replace_day(fact, lake.fact, "job_date", job_date),
            replace_day(bad, lake.rejects, "job_date", job_date),
        )
    if counts.read != counts.accepted + counts.rejected:
        raise RuntimeError(f"E005: rows of {job_date} do not add up: {counts}")
    return counts


def log_run(row: DataFrame, lake: Lake) -> None:
    with_retry(lambda: append(row, lake.job_log, evolve=True))
