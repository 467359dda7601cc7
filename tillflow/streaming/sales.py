"""Sales judged as they arrive, each id once.

A preview of the day: the day's run judges all rows of the day again, with every reason.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.operators.rejects import typed_clean_sales, usable
from tillflow.sinks.tables import replace_partitions


def accepted_stream(rows: DataFrame, as_of: datetime, delay: str) -> DataFrame:
    """Of a stream of raw sales (see ``stream_feed``) the usable ones, typed, one per id.

    An id is remembered for ``delay`` (say ``'3 days'``) behind the latest sale seen,
    over micro-batches and restarts. Whatever is older than that is too late: it
    is left out, since nobody remembers its id. Of the copies in one micro-batch any stays.
    """
    kept = [name for name in ("_source_file", "_job_date") if name in rows.columns]
    sales = typed_clean_sales(rows, *kept).where(usable(as_of))
    return sales.withWatermark("transaction_time", delay).dropDuplicatesWithinWatermark(["transaction_id"])


def land_sales(sales: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write what arrived since the last run to ``table``, a partition ``micro_batch`` at a time, then stop.

    A micro-batch that runs again after a failure writes its partition again.
    """
    catalog = sales.sparkSession.catalog

    def land(batch: DataFrame, number: int) -> None:
        replace_partitions(batch.withColumn("micro_batch", F.lit(number).cast("long")), table)
        catalog.refreshTable(table)

    writer = sales.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
