"""Session settings this library is written for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE coalesces small shuffle partitions, turns a join into a broadcast join once the
# real size is known and splits skewed partitions, so the partition count below is an
# upper bound for a cluster and not a tuning target.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", app: str = "lastro", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lastro-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def releasing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, an action removes its shuffle files when it ends, and not when the driver's heap is next collected.

    For actions whose result is kept elsewhere, so that nothing would read these files again.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The table written to the shared folder and read back.

    For a table that several later steps read: its source is scanned once, later plans
    start at the files, and a lost executor has something to restart from.  Shuffle files
    of the writing are removed with its end.  ``partition_by`` names columns by whose values parts of it are read.
    """
    path = scratch_path(df.sparkSession, name)
    with releasing_shuffles(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` that nothing lazy reads any more, since what came of them is stored too."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
