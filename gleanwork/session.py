"""Session helpers: a local session for tests and a shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


# While a table is written: Spark removes the shuffle files of a query that has
# ended, and samples fewer rows per range, as they go to the driver with points.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.rangeExchange.sampleSizePerPartition": "20",
}

# What the settings were, then an entry for every table that is being written.
_BEFORE: list[dict | None] = []
_LOCK = Lock()

# Where scratch tables go below the shared folder.
_FOLDER: ContextVar[str] = ContextVar("folder", default="gleanwork")


def local_session(cores: int = 8, name: str = "gleanwork") -> SparkSession:
    """A single-JVM session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    ``spark.checkpoint.dir`` names it. Only a local session without that
    setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="gleanwork-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_dir(spark).rstrip('/')}/{_FOLDER.get()}/{uuid.uuid4().hex}/{name}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark).rstrip('/')}/{folder}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that are written inside.

    For jobs that end in numbers on the driver: nothing reads their tables
    later. What should outlive the block goes to a ``Shelf`` made before it.
    """
    folder = f"{_FOLDER.get()}/{uuid.uuid4().hex}"
    mark = _FOLDER.set(folder)
    try:
        yield
    finally:
        _FOLDER.reset(mark)
        _delete(spark, folder)


class Shelf:
    """Keeps the tables of the best result so far.

    A shelf lies in the folder that was current when it was made, so tables
    put there inside a ``tidy`` block stay when the block ends. Putting new
    tables deletes those they replace.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.outer, self.held = spark, _FOLDER.get(), None

    def put(self, *tables: DataFrame) -> list[DataFrame]:
        """Write ``tables`` to the shelf in place of what lies there."""
        before, self.held = self.held, f"{self.outer}/{uuid.uuid4().hex}"
        mark = _FOLDER.set(self.held)
        try:
            kept = [settle(t) for t in tables]
        finally:
            _FOLDER.reset(mark)
        if before:
            _delete(self.spark, before)
        return kept


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts the lineage of iterative jobs, pins values that must not change when
    a lost executor's work is redone (partition numbers, block ids), and lets
    several consumers read only the columns they need. Written with zstd: it is
    read few times and holds texts or ids, so space counts more than speed.
    Nothing reads the shuffles behind ``df`` once it is written: Spark is told
    to remove their files at the end of the write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    with _writing(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _writing(spark: SparkSession) -> Iterator[None]:
    """``_WRITING`` holds inside. Threads share the settings of a session: the
    first one in sets them and the last one out restores them."""
    with _LOCK:
        if not _BEFORE:
            _BEFORE.append({name: spark.conf.get(name, None) for name in _WRITING})
            for name, value in _WRITING.items():
                spark.conf.set(name, value)
        _BEFORE.append(None)
    try:
        yield
    finally:
        with _LOCK:
            _BEFORE.pop()
            if len(_BEFORE) == 1:
                for name, value in _BEFORE.pop().items():
                    if value is None:
                        spark.conf.unset(name)
                    else:
                        spark.conf.set(name, value)


def side_by_side(work: Callable, items: Iterable, width: int = 4) -> list[Any]:
    """``work`` of every item, in order, with a few Spark jobs at a time.

    For independent fits and scores: the short last tasks of one job overlap
    with the next job.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(width) as pool:
        tasks = [pool.submit(copy_context().run, inherit(work), item) for item in items]
        return [task.result() for task in tasks]


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for an input that arrives in fewer partitions than cores.

    Small files come as one partition and would keep heavy per-row work on one
    core. A large input has more partitions than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
