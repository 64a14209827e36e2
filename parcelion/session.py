"""Session helpers: local sessions, the shared folder, staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "parcelion", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the bench. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="parcelion-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/parcelion/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later passes read the stored columns instead of recomputing the lineage, a lost
    executor costs no recomputation, and Catalyst knows the true size of the table:
    it broadcasts a staged side only below ``spark.sql.autoBroadcastJoinThreshold``
    and otherwise uses a shuffle join, where adaptive execution splits skewed keys.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    if blocks := _BLOCKS.get():
        blocks[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_table(df: DataFrame, name: str = "kept") -> DataFrame:
    """As :func:`stage_table`, for a result of the innermost block of :func:`released_after`: it outlives that block and
    goes with the one around it, if there is one."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    if len(blocks := _BLOCKS.get()) > 1:
        blocks[-2].append(path)
    return spark.read.schema(df.schema).parquet(path)


# Paths staged within each open block of :func:`released_after`, the innermost last. Threads started by a
# flow share its blocks when they run in a copy of its context.
_BLOCKS: ContextVar[tuple[list[str], ...]] = ContextVar("staged", default=())


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


@contextmanager
def released_after(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when it ends. For flows whose results are
    written inside the block; a result that is still to be computed needs its tables.
    Blocks of flows that run side by side do not touch each other's tables."""
    paths: list[str] = []
    token = _BLOCKS.set((*_BLOCKS.get(), paths))
    try:
        yield
    finally:
        _BLOCKS.reset(token)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
