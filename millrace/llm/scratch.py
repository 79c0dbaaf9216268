"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


class Scratch:
    """Tables of one run.  ``replace`` drops a table once its successor is stored."""

    def __init__(self, spark) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def store(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and go on from the written rows: cuts the lineage and freezes
        columns that are not the same when computed again.  Shuffle files of earlier steps
        are deleted: Spark does so once the driver's JVM has collected what held them."""
        self.spark._jvm.java.lang.System.gc()
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        self.paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def replace(self, df: DataFrame, label: str) -> DataFrame:
        """Store anew what may itself be computed from the table of that label."""
        old = self.paths.get(label)
        stored = self.store(df, label)
        if old:
            self._delete(old)
        return stored

    def drop(self, *labels: str) -> None:
        """Delete tables that nothing reads any more."""
        for label in labels:
            if label in self.paths:
                self._delete(self.paths.pop(label))

    def keep_only(self, *labels: str) -> None:
        """Delete all tables but those of these labels."""
        self.drop(*[label for label in self.paths if label not in labels])

    def _delete(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
