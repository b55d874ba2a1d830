"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

PARTITION_BYTES = 256 * 2**20
POOL = "spark.scheduler.pool"

T = TypeVar("T")


def session_builder(app: str = "carebase") -> SparkSession.Builder:
    """Settings the library is tuned for. Sizes (memory, partitions) are left to the cluster."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        # Datasets refined side by side share the cluster evenly, each in a pool of its own.
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
        # The JVM does not compile methods of more than 8000 bytes. The cleaning of a wide
        # table generates larger ones unless Spark is told to split them.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )


@contextmanager
def shuffle_partitions_for(spark: SparkSession, data_bytes: int) -> Iterator[None]:
    """Enough shuffle partitions for a job that shuffles ``data_bytes``, never fewer than set.

    Adaptive execution can merge small partitions of an aggregation, but not split large
    ones, so the number has to be high enough from the start.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    needed = data_bytes // PARTITION_BYTES + 1
    spark.conf.set(name, max(int(before), needed))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def own_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster that starts with the settings of ``spark``.

    Settings changed in one of the two are not seen in the other.
    """
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name) and session.conf.get(name, None) != value:
            session.conf.set(name, value)
    return session


def side_by_side(
    spark: SparkSession, work: Mapping[str, Callable[[SparkSession], T]], at_once: int
) -> list[T]:
    """The results of ``work``, in its order; up to ``at_once`` of it runs at a time.

    Each piece runs in a thread and a session of its own, its jobs in a scheduler pool of its
    name. An error that a piece raises is raised here when all have ended.
    """

    def one(name: str) -> T:
        spark.sparkContext.setLocalProperty(POOL, name)
        try:
            return work[name](own_session(spark))
        finally:
            spark.sparkContext.setLocalProperty(POOL, None)

    with ThreadPoolExecutor(max_workers=max(at_once, 1)) as threads:
        # Wrapped one by one: the wrapper copies the caller's properties when it is made.
        started = [threads.submit(inheritable_thread_target(spark)(one), name) for name in work]
    return [piece.result() for piece in started]


@cache
def _local_scratch() -> str:
    base = tempfile.mkdtemp(prefix="carebase-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that ``spark.checkpoint.dir`` names.

    Executors on other machines must see what is written there, so only a local
    session without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, stored as Parquet in the shared folder and read back.

    Cuts the lineage: an executor lost later costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
