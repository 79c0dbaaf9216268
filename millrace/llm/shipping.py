"""The package on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED = "_millrace_shipped"

# Texts of an Arrow batch; Spark's own 10,000 suit numbers.
BATCH_TEXTS = 1_000


def ship(spark: SparkSession) -> SparkSession:
    """Give this package to the Python workers, once per context.

    Tasks of this subpackage import it.  Where it is not installed on the machines of the
    executors, Spark sends them this archive of its sources (a tenth of a megabyte) from
    the driver; no task reads the driver's file.
    """
    context = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    if getattr(context, _SHIPPED, False) or not package.is_dir():
        return spark
    archive = Path(tempfile.mkdtemp(prefix="millrace-")) / "millrace.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    setattr(context, _SHIPPED, True)
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Rows go to Python in batches of at most BATCH_TEXTS, all rows as before.

    A batch is held by the JVM, beside its heap, and by Python at once, for each task.
    The option is read when a table is planned, after a stage has returned it, so the
    session keeps it.  A smaller number that is set already stays.
    """
    option = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = int(spark.conf.get(option))
    if not 0 < usual <= BATCH_TEXTS:
        spark.conf.set(option, BATCH_TEXTS)
    return spark
