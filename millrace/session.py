"""Session settings the operators rely on, and the shared scratch area.

Nothing here starts a session.  The library runs on whatever session it is
given; ``prepare`` sets the two runtime options results depend on.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Options that decide results: event times are UTC, and of a repeated key in a JSON
# object the last one counts.
RESULT_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the options results depend on, where they are not set already."""
    for option, value in RESULT_OPTIONS.items():
        if spark.conf.get(option, None) != value:
            spark.conf.set(option, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` (or a checkpoint dir already set on the context)
    wins.  Only a local session may fall back to a fresh temporary folder; on a
    cluster a machine-local folder would be invisible to the other machines.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    fresh = tempfile.mkdtemp(prefix="millrace-")
    context.setCheckpointDir(fresh)
    return fresh


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none if it does not exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place) if status.isDirectory())


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks for each core while this holds.

    Spark takes a task for each folder, up to 10,000 of them, each of which costs far more
    than the names of a small folder.  Files are listed when a reader loads its paths.
    """
    option = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    usual = spark.conf.get(option)
    spark.conf.set(option, min(int(usual), 4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(option, usual)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and continue from the stored columns.

    Cuts lineage with a table that survives executor loss, and freezes columns
    that are not reproducible (partition numbers, row positions).  Written once,
    where ``checkpoint()`` would compute the input twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
