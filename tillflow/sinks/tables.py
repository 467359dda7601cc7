"""Writing catalogue tables so that a repeated run leaves the same contents."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from time import sleep
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMAT = "parquet"
# For tables and intermediate rows whose bytes matter more than how the planner sizes them.
COMPACT = "zstd"
Result = TypeVar("Result")


def create_layer(spark: SparkSession, layer: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{place}")


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = (),
    compression: str | None = None,
) -> None:
    """Declare a table; its partition columns must be the last of ``schema``.

    ``compression`` is that of its files, the session's if not given.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    options = f" OPTIONS (compression '{compression}')" if compression else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {FORMAT}{options}{parts}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """From the catalogue, without a job; listing columns by ``spark.catalog`` makes one or more."""
    names = [row["col_name"] for row in spark.sql(f"DESCRIBE TABLE {table}").collect()]
    return names[names.index("# col_name") + 1:] if "# Partition Information" in names else []


def partition_values(spark: SparkSession, table: str) -> set[str]:
    """The values of a table's only partition column, from the catalogue."""
    return {row["partition"].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def add_columns(df: DataFrame, table: str) -> None:
    """Give the table the columns of ``df`` it does not have yet."""
    spark = df.sparkSession
    known = set(spark.table(table).columns)
    new = [f for f in df.schema.fields if f.name not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in its order and types, absent ones as NULL.

    The rebalance brings the rows of a partition together, so a write of many
    partitions makes few files in each. Adaptive execution divides a partition
    with very many rows. See ``one_partition`` for writes that do without.
    """
    spark = df.sparkSession
    fields = spark.table(table).schema.fields
    present = set(df.columns)
    rows = df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )
    return rows if _one.get() or not _gathered.get() else rows.hint("rebalance", *partition_columns(spark, table))


_one: ContextVar[bool] = ContextVar("one_partition", default=False)
_gathered: ContextVar[bool] = ContextVar("gathered", default=True)


@contextmanager
def one_partition() -> Iterator[None]:
    """Writes inside are of rows that all belong to one partition, so nothing is shuffled or sorted to
    bring them together: each task that has rows writes one file."""
    before = _one.set(True)
    try:
        yield
    finally:
        _one.reset(before)


OVERWRITE, OPEN_FILES = "spark.sql.sources.partitionOverwriteMode", "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _only_written_partitions(spark: SparkSession, open_files: int = 0) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in (OVERWRITE, OPEN_FILES)}
    spark.conf.set(OVERWRITE, "dynamic")
    spark.conf.set(OPEN_FILES, open_files)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def replace_partitions(
    df: DataFrame, table: str, evolve: bool = False, at_most: int = 0, gather: bool = True
) -> None:
    """Overwrite the partitions ``df`` has rows for; all others stay.

    Writing a day or a batch again therefore does not add its rows twice. ``at_most`` says, if
    known, how many partitions a task may have rows of. A task then has a file open for each
    and does not sort its rows by partition, which spills once they exceed its memory; a
    task that finds more partitions sorts the rest. Without ``gather`` rows stay in their tasks
    and are not shuffled: each task writes a file for every partition it has rows of.
    """
    if evolve:
        add_columns(df, table)
    expected = at_most or int(_one.get())
    # A task that opens the last file it may have open goes over to sorting, so one more may be.
    before = _gathered.set(gather)
    try:
        with _only_written_partitions(df.sparkSession, expected and expected + 1):
            _aligned(df, table).write.insertInto(table, overwrite=True)
    finally:
        _gathered.reset(before)


def append(df: DataFrame, table: str, evolve: bool = False) -> None:
    if evolve:
        add_columns(df, table)
    _aligned(df, table).write.insertInto(table)


def replace_table(df: DataFrame, table: str) -> None:
    """Full refresh; columns of ``df`` replace those of the table.

    The rows are written to a folder of their own first. The table then points
    to it, so a failed write leaves the old table and its files as they were. Where
    columns change, a new table takes the old one's name; a failure in between
    leaves the old one under its name with ``__former``, which the next refresh
    and ``restore_table`` put back. The folder before stays for plans that still read
    it, until the next refresh.
    """
    spark = df.sparkSession
    restore_table(spark, table)
    known = spark.catalog.tableExists(table)
    old = _details(spark, table)["Location"] if known else None
    place = _place(spark, table)
    folder = f"{place}-{uuid.uuid4().hex}"
    df.hint("rebalance").write.format(FORMAT).save(folder)
    same = known and [(f.name, f.dataType) for f in spark.table(table).schema.fields] == [
        (f.name, f.dataType) for f in df.schema.fields
    ]
    if same and not partition_columns(spark, table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    else:
        made = table + NEXT if known else table
        spark.sql(f"DROP TABLE IF EXISTS {made}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {made} ({columns}) USING {FORMAT} LOCATION '{folder}'")
        if known:
            spark.sql(f"ALTER TABLE {table} RENAME TO {table}{FORMER}")
            spark.sql(f"ALTER TABLE {made} RENAME TO {table}")
            spark.sql(f"DROP TABLE {table}{FORMER}")
    spark.catalog.refreshTable(table)
    _remove_older(spark, place, {folder, old})


NEXT, FORMER = "__next", "__former"


def restore_table(spark: SparkSession, table: str) -> None:
    """Puts right what a refresh that ended between two statements left behind."""
    if spark.catalog.tableExists(table + FORMER):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {table}{FORMER}")
        else:
            spark.sql(f"ALTER TABLE {table}{FORMER} RENAME TO {table}")


def _remove_older(spark: SparkSession, place: str, but: set[str | None]) -> None:
    """Removes the folders of earlier refreshes."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(place + "-" + "[0-9a-f]" * 32)
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())

    def bare(path: str) -> str:
        return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()

    kept = {bare(path) for path in but if path}
    for found in files.globStatus(pattern) or ():
        if found.getPath().toUri().getPath() not in kept:
            files.delete(found.getPath(), True)


def _place(spark: SparkSession, table: str) -> str:
    """The folder a table has by default: its name in its layer's folder."""
    layer, _, name = table.rpartition(".")
    database = spark.catalog.getDatabase(layer or spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{name}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, folder: str, compression: str | None = None) -> DataFrame:
    """``df`` written to a shared folder and read from there.

    Cuts the lineage, survives lost executors, and tells the planner the size. Lists that may be
    broadcast by that size stay with the session's compression.
    """
    writer = df.write.format(FORMAT)
    (writer.option("compression", compression) if compression else writer).save(folder)
    return df.sparkSession.read.schema(df.schema).format(FORMAT).load(folder)


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` and its row count, taken during the write that follows."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rows_seen(seen: Observation) -> int | None:
    """The count after a successful write; None if the plan took none.

    Adaptive execution drops a plan it finds empty, and the count with it. A count
    is for reporting: stages that run again may be counted again.
    """
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return None


def replace_day(rows: DataFrame, table: str, column: str, day: str) -> int:
    """Overwrite one day's partition of a table; returns the rows it then has.

    An overwrite without rows names no partition, so the old day is dropped then:
    if neither the write of the attempt that succeeded saw a row nor the rows
    themselves have one. The count is of what the table holds afterwards.
    """
    def attempt() -> int | None:
        watched, seen = counted(rows, f"rows_{uuid.uuid4().hex}")
        with one_partition():
            replace_partitions(watched, table, evolve=True)
        return rows_seen(seen)

    spark = rows.sparkSession
    if not with_retry(attempt) and rows.isEmpty():
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{day}')")
        return 0
    return spark.table(table).where(F.col(column) == day).count()


def with_retry(write: Callable[[], Result], attempts: int = 3, wait: float = 1.0) -> Result:
    """Repeat a write that failed at run time; only for writes that may safely run again.

    A plan that cannot be made, say of a missing column, fails at once.
    """
    for attempt in range(1, attempts + 1):
        try:
            return write()
        except AnalysisException:
            raise
        except (PySparkException, Py4JJavaError) as error:
            if attempt == attempts:
                raise RuntimeError(f"E005: write failed {attempts} times") from error
            sleep(wait * attempt)
    raise ValueError("attempts must be one or more")


def side_by_side(
    spark: SparkSession, write: Callable[[str], Result], names: Iterable[str], at_once: int = 4
) -> dict[str, Result]:
    """What ``write`` gives for each name, some at a time; the first failure is raised once all have ended.

    Only for writes that change no setting of the session, as ``replace_partitions`` does.
    """
    with ThreadPoolExecutor(at_once) as pool:
        pending = {name: pool.submit(inheritable_thread_target(spark)(write), name) for name in names}
    return {name: each.result() for name, each in pending.items()}


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    return {
        row["col_name"].strip(): row["data_type"]
        for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    }


def describe(spark: SparkSession, table: str) -> DataFrame:
    """Format, location and partition columns of a table, as one row."""
    detail = _details(spark, table)
    return spark.createDataFrame(
        [(table, detail["Provider"], detail["Location"], partition_columns(spark, table))],
        "name STRING, format STRING, location STRING, partition_columns ARRAY<STRING>",
    )
