"""What the training-data operators share: tables, byte texts, settled results."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()
_LOCAL: dict[str, str] = {}


def ship_code(spark: SparkSession) -> None:
    """Gives this package to the Python workers of the session's executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tillflow-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for file in sorted(package.rglob("*.py")):
            target.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors."""
    ship_code(df.sparkSession)
    return df.mapInArrow(function, schema)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a local session may go without: executors share nothing else."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL.get(spark.sparkContext.applicationId)
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="tillflow-shared-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return shared.rstrip("/")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables below the shared one; it goes when the application ends."""
    path = f"{shared_folder(spark)}/tillflow/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def removed(spark: SparkSession, path: str) -> None:
    """Removes a scratch folder that no plan reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a scratch folder and read again: computed once, lineage cut."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: computed once, lineage cut.

    Spark removes it when nothing refers to it, if its cleaner is told to clean checkpoints.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def spread(df: DataFrame, *keys: Column | str) -> DataFrame:
    """``df`` dealt by hash of ``keys`` into the session's shuffle partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES):
    """The batches cut to rows whose ``column`` holds about ``limit`` bytes; a longer row stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def text_column(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
