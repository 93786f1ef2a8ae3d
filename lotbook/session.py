"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key in a sort-merge join is split at run time, even where the split costs the
    # next operator another exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def spark_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder stands in only on a local master, where driver and executors share
    one disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="lotbook-")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Removes what this application wrote to its scratch folder and no longer needs."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go when it ends. Otherwise they stay until the driver
    happens to collect garbage, and those of many written tables add up on the executors' disks."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to a new Parquet folder that all executors share, and read back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(*steps: Callable[[], object], threads: int = 4) -> list:
    """Runs steps that do not need each other from a few threads, so that one's last tasks leave
    cores to the next; each has a pool of its own where the cluster shares fairly. The first
    failure is raised when all have ended."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()

    def run(step: Callable[[], object]) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"step-{id(step)}")
        return step()

    with ThreadPoolExecutor(threads) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(run), s) for s in steps]]
