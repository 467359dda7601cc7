"""Fewer, larger and better sorted files in the partitions of a table."""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.sinks.tables import partition_columns

TARGET_BYTES = 128 * 1024 * 1024
SAMPLE = 4_096
BITS = 6
# Scans pass over names that begin with an underscore.
STAGED, PLAN = "_compact-", "_compaction.json"


def file_sizes(rows: DataFrame) -> DataFrame:
    """The files behind a scan and their sizes."""
    meta = F.col("_metadata")
    return rows.select(
        meta["file_path"].alias("file"), meta["file_size"].alias("bytes")
    ).distinct()


def compact(
    spark: SparkSession, table: str, target_bytes: int = TARGET_BYTES,
    order_by: Sequence[str] = (), **partition: str,
) -> int:
    """Merge the small files of the partitions named; returns how many files were written.

    Small are files of less than half ``target_bytes``; all others stay as they are.
    Without ``order_by`` no row is shuffled: the scan packs small files into tasks
    of about ``target_bytes``, and each task writes one file. With it the rows
    of the small files are ordered along a curve that keeps rows near in all of
    these columns together, so that a filter on any of them reads few files.

    The merged files are written to a hidden folder in the partition's, compared
    with the small ones, and a plan of the exchange is written. Only then are
    they moved beside the large files and the small ones removed. A failure
    before the plan leaves the partition as it was; after it, the exchange is
    finished by the next ``compact`` or by ``finish_compaction``. Until then rows may
    be seen twice, so a partition is compacted while nothing reads or writes it.
    """
    finish_compaction(spark, table, **partition)
    rows = _partition(spark, table, partition)
    small = defaultdict(list)
    for found in file_sizes(rows).where(F.col("bytes") < target_bytes // 2).toLocalIterator():
        path = _path(spark, found["file"])
        small[path.getParent().toString()].append((path.toString(), found["bytes"]))
    hive = set(partition_columns(spark, table))
    schema = T.StructType([f for f in spark.table(table).schema.fields if f.name not in hive])
    made = 0
    for folder, files in small.items():
        if len(files) > 1:
            made += _merge(spark, folder, files, schema, target_bytes, order_by)
    spark.catalog.refreshTable(table)
    return made


def finish_compaction(spark: SparkSession, table: str, **partition: str) -> int:
    """Finish exchanges that a failure interrupted, remove what others left; returns how many were finished."""
    folders = {
        _path(spark, file).getParent().toString()
        for file in _partition(spark, table, partition).inputFiles()
    }
    finished = sum(_exchange(spark, folder) for folder in sorted(folders))
    if finished:
        spark.catalog.refreshTable(table)
    return finished


def _partition(spark: SparkSession, table: str, partition: dict[str, str]) -> DataFrame:
    rows = spark.table(table)
    for name, value in partition.items():
        rows = rows.where(F.col(name) == value)
    return rows


def _merge(
    spark: SparkSession, folder: str, files: list[tuple[str, int]], schema: T.StructType,
    target_bytes: int, order_by: Sequence[str],
) -> int:
    total = sum(size for _, size in files)
    staged = f"{folder}/{STAGED}{uuid.uuid4().hex}"
    with _packed_scans(spark, target_bytes):
        rows = spark.read.schema(schema).parquet(*[file for file, _ in files])
        sorted_rows = rows
        if order_by:
            keys = [interleaved(rows, order_by), *order_by]
            sorted_rows = rows.repartitionByRange(-(-total // target_bytes), *keys).sortWithinPartitions(*keys)
        sorted_rows.write.parquet(staged)
        copy = spark.read.schema(schema).parquet(staged)
        if _digest(copy) != _digest(rows):
            raise RuntimeError(f"copy of small files of {folder} in {staged} differs from them")
    made = [name for name in _names(spark, staged) if not name.startswith(("_", "."))]
    _write_plan(spark, folder, {
        "staged": staged.rpartition("/")[2],
        "old": [file.rpartition("/")[2] for file, _ in files],
        "new": made,
    })
    _exchange(spark, folder)
    return len(made)


def _exchange(spark: SparkSession, folder: str) -> bool:
    """Carry out a folder's plan, which may be half done, and remove staged files without one."""
    place = _path(spark, folder, uri=False)
    files = _files(spark, place)
    plan_file = _path(spark, f"{folder}/{PLAN}", uri=False)
    found = files.exists(plan_file)
    if found:
        plan = json.loads(_read(files, plan_file))
        for name in plan["new"]:
            source = _path(spark, f"{folder}/{plan['staged']}/{name}", uri=False)
            target = _path(spark, f"{folder}/{name}", uri=False)
            if not files.exists(target) and not files.rename(source, target):
                raise RuntimeError(f"{source} could not be moved to {target}")
        for name in plan["old"]:
            files.delete(_path(spark, f"{folder}/{name}", uri=False), False)
        files.delete(plan_file, False)
    for name in _names(spark, folder):
        if name.startswith(STAGED):
            files.delete(_path(spark, f"{folder}/{name}", uri=False), True)
    return found


def _write_plan(spark: SparkSession, folder: str, plan: dict) -> None:
    """The plan appears whole or not at all: it takes its name when it is written."""
    draft = _path(spark, f"{folder}/{plan['staged']}/{PLAN}", uri=False)
    files = _files(spark, draft)
    out = files.create(draft, True)
    try:
        out.write(bytearray(json.dumps(plan).encode()))
    finally:
        out.close()
    if not files.rename(draft, _path(spark, f"{folder}/{PLAN}", uri=False)):
        raise RuntimeError(f"no plan could be written to {folder}")


def _read(files: JavaObject, path: JavaObject) -> str:
    source = files.open(path)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def _path(spark: SparkSession, name: str, uri: bool = True) -> JavaObject:
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name) if uri else name)


def _files(spark: SparkSession, path: JavaObject) -> JavaObject:
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    path = _path(spark, folder, uri=False)
    return [status.getPath().getName() for status in _files(spark, path).listStatus(path)]


@contextmanager
def _packed_scans(spark: SparkSession, target_bytes: int) -> Iterator[None]:
    """Scans whose tasks read about ``target_bytes`` each, however many cores there are."""
    settings = {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def interleaved(rows: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """A sort key of the columns' bits in turn, the highest first.

    A column's bits are the place of its value among bounds taken from a sample
    of ``SAMPLE`` rows, so columns of any ordered type and distribution weigh
    alike. Missing values come first. The sample decides the order of rows only.
    """
    drawn = rows.select(*columns).orderBy(F.rand(1)).limit(SAMPLE).collect()
    key = F.lit(0).cast("long")
    places = []
    for at in range(len(columns)):
        values = sorted({row[at] for row in drawn if row[at] is not None})
        parts = min(len(values), (1 << bits) - 1)
        bounds = [F.lit(values[part * len(values) // parts]) for part in range(parts)]
        column = F.col(f"`{columns[at]}`")
        place = _place(column, bounds, 0, parts)
        # Stretched over all bits, so that columns of few values weigh as much.
        place = F.floor(place * ((1 << bits) - 1) / max(parts, 1))
        places.append(F.when(column.isNull(), 0).otherwise(place).cast("long"))
    for bit in range(bits):
        for at, place in enumerate(places):
            # Of one bit of all columns the first column's is the highest.
            to = bit * len(places) + len(places) - 1 - at
            key = key.bitwiseOR(F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1).cast("long")), to))
    return key


def _place(column: Column, bounds: Sequence[Column], first: int, last: int) -> Column:
    """How many of the ascending ``bounds`` are not above the value, if from ``first`` to ``last`` are: by halves."""
    if first == last:
        return F.lit(first)
    middle = (first + last) // 2
    return F.when(column < bounds[middle], _place(column, bounds, first, middle)).otherwise(
        _place(column, bounds, middle + 1, last))


def _digest(rows: DataFrame) -> tuple:
    """Row count and an order-free sum over all values."""
    total = F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))
    return tuple(rows.agg(F.count("*"), total).first())
