"""Session settings and the shared folder for intermediate data."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import count

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Without this every column call also records where in Python it was made.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str = "tillflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's settings; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def temporary_workspace(spark: SparkSession, name: str) -> Iterator[Callable[[], str]]:
    """Gives fresh folders below the shared one, and removes them afterwards."""
    root = workspace(spark, name)
    numbers = count()
    try:
        yield lambda: f"{root}/{next(numbers)}"
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder; it goes when the application ends.

    Only a local session may go without ``spark.checkpoint.dir``: it gets a
    temporary folder of this machine, which goes away with the process. On a
    cluster the executors would not see each other's files there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        folder = f"{shared.rstrip('/')}/tillflow/{name}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix=f"tillflow-{name}-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    return local
