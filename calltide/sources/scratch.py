"""Shared folder for intermediate tables and stream checkpoints."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_run: ContextVar[str | None] = ContextVar("run", default=None)


def _base(spark: SparkSession) -> str:
    set_dir = spark.conf.get(_SETTING, None)
    if set_dir:
        return set_dir.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith("file:") and warehouse.endswith("/spark-warehouse") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{warehouse} is a folder of one machine: set {_SETTING} to one that all machines share")
    return f"{warehouse}/scratch"


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's checkpoint folder, else below the warehouse.

    Without either setting a session on one machine uses its own warehouse
    folder; on a cluster that raises. Inside a job the path lies in the job's
    own folder.
    """
    return f"{_run.get() or _base(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A folder for what is staged inside the block, deleted at its end, or the one that is open already."""
    if _run.get():
        yield
        return
    folder = shared_dir(spark, "run")
    token = _run.set(folder)
    try:
        yield
    finally:
        _run.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def own_scratch(job: Callable) -> Callable:
    """Run a job, whose first argument is a session or a DataFrame, inside ``scratch``. Its result must read none of it."""

    @functools.wraps(job)
    def run(first: SparkSession | DataFrame, *args, **kwargs):
        with scratch(first if isinstance(first, SparkSession) else first.sparkSession):
            return job(first, *args, **kwargs)

    return run
