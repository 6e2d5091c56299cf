"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on. Every one may be set on a live session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # a season such as 2001-02 is text, also where it names a folder
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle further up
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # files of a few parts are written side by side instead of after a sort
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

# Bytes that one task reads of a shuffle or of a file, at most: the sorts and hash tables of a task hold several times as much.
# A session that was given less keeps it.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20, "spark.sql.files.maxPartitionBytes": 32 << 20}

# Lets an execution remove its shuffle files when it ends.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Paths settled in each open ``passing`` block, the innermost last.
_passing: ContextVar[tuple[list[str], ...]] = ContextVar("_passing", default=())


def build(app: str = "courtside", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ready(spark: SparkSession, width: int | None = None) -> SparkSession:
    """Apply the runtime settings to a session somebody else built.

    ``width`` is the number of shuffle partitions before adaptive execution merges small ones.
    Merging is all it does outside joins, so the number must suit the largest shuffle: on a
    cluster it is at least twice the cores. A local session keeps what it was given.
    """
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    as_bytes = context._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in TASK_BYTES.items():
        if as_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    if width is None and not context.master.startswith("local"):
        width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * context.defaultParallelism)
    if width is not None:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(width))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it gets a fresh temporary
    folder. On a cluster a missing setting is an error, never a machine-local path.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    named = tempfile.mkdtemp(prefix="courtside-")
    spark.conf.set("spark.checkpoint.dir", named)
    spark.sparkContext.setCheckpointDir(named)
    return named


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files when they end.

    Otherwise these files stay until the driver happens to collect its garbage, so a run of many writes holds the shuffles
    of all. For writes only: a DataFrame that is run again would have to make its removed files again.
    """
    before = spark.conf.get(FREES_SHUFFLES, None)
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREES_SHUFFLES)
        else:
            spark.conf.set(FREES_SHUFFLES, before)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables settled inside are removed at the end, also when it fails; by then whatever reads them must have been written."""
    paths: list[str] = []
    outer = _passing.set((*_passing.get(), paths))
    try:
        yield
    finally:
        _passing.reset(outer)
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str, stays: bool = False) -> DataFrame:
    """Write rows that several later steps read, and go on from the written table.

    Cuts the lineage in the shared folder, so a lost executor does not repeat the joins
    above; readers prune columns and know the true size. The shuffles above leave the disk
    with the write. ``stays`` keeps the table beyond the innermost ``passing`` block.
    """
    path = fresh_path(df.sparkSession, label)
    blocks = _passing.get()[:-1] if stays else _passing.get()
    if blocks:
        blocks[-1].append(path)
    with freeing_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
