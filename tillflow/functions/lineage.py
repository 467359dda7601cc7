"""Where a row came from and which run wrote it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment_sql(at: datetime) -> str:
    """SQL for a moment: one with a zone is that instant, one without is in the session's zone."""
    return f"TIMESTAMP '{at.isoformat(sep=' ', timespec='microseconds')}'"


def moment(at: datetime | None) -> Column:
    return F.current_timestamp() if at is None else F.expr(moment_sql(at))


def add_lineage(
    scanned: DataFrame,
    batch_id: str,
    job_date: str | Column | None = None,
    at: datetime | None = None,
) -> DataFrame:
    """Ingestion columns for bronze; ``_source_file`` comes from the scan.

    Dated feeds pass a ``job_date`` and end in their partition columns.
    """
    stamps = {"_ingestion_timestamp": moment(at)}
    if job_date is not None:
        stamps["_job_date"] = job_date if isinstance(job_date, Column) else F.lit(job_date)
    stamps["_batch_id"] = F.lit(batch_id)
    return scanned.withColumns(stamps)


def add_audit(
    df: DataFrame,
    batch_id: str,
    job_date: str,
    source_system: str,
    at: datetime | None = None,
) -> DataFrame:
    """Run columns for silver."""
    return df.withColumns(
        {
            "batch_id": F.lit(batch_id),
            "processed_timestamp": moment(at),
            "source_system": F.lit(source_system),
            "job_date": F.lit(job_date),
        }
    )
