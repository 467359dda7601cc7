"""Landing newly arrived files of a feed, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.functions.lineage import add_lineage
from tillflow.schemas import CORRUPT, feed_schema
from tillflow.sinks.tables import replace_partitions, replace_table
from tillflow.sources.feeds import Feed, date_in_path, to_text_columns, with_corrupt


def stream_feed(
    spark: SparkSession,
    feed: Feed,
    folder: str,
    batch_id: str,
    pattern: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of the feed's files with the lineage columns of a batch run.

    The job date is the one in the file name. CSV headers are checked against
    the feed's columns. ``files_per_trigger`` bounds one micro-batch.
    """
    reader = spark.readStream.option("pathGlobFilter", pattern or f"{feed.name}*.{feed.suffix}")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if feed.kind == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        reader = reader.schema(with_corrupt(feed_schema(feed.name)))
    elif feed.kind == "parquet":
        reader = reader.schema(feed_schema(feed.name))
    # JSON is read as lines, so that what the contract does not name is kept.
    kind = "text" if feed.kind == "json" else feed.kind
    rows = to_text_columns(reader.format(kind).load(folder), feed)
    job_date = date_in_path(F.col("_source_file")) if feed.dated else None
    return add_lineage(rows, batch_id, job_date)


def land_stream(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Land all files waiting now in the feed's bronze table, then stop.

    The checkpoint remembers which files are done. A micro-batch of a dated feed
    is a batch of its own, named by the stream's batch and the micro-batch's
    number, and overwrites its partitions, so one that runs again after a failure
    neither loses nor repeats rows. A master feed is refreshed by each micro-batch.
    """
    catalog = rows.sparkSession.catalog

    def land(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        if "_job_date" in batch.columns:
            own = F.format_string(f"%s-{number:09d}", F.col("_batch_id"))
            replace_partitions(batch.withColumn("_batch_id", own), table, evolve=True)
        else:
            replace_table(batch, table)
        # The batch has a session of its own; this one may have listed the table before.
        catalog.refreshTable(table)

    writer = rows.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
