"""Shared-storage helpers: where intermediate tables go and how they are cleaned up.

Iterative operators cut their lineage by writing Parquet below the folder that
``spark.checkpoint.dir`` names, which every executor of a cluster can reach.
Only where that setting is absent (local tests) is a temporary folder chosen.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a fresh temporary one if none is set and all runs on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lodestar-"))
    return context._jsc.sc().getCheckpointDir().get()


class Scratch:
    """Tables written to shared storage under one folder, removable one by one; all go when the application ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self.saved: list[DataFrame] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return the frame that reads it back."""
        path = self.path(name)
        if not self.saved:
            target, files = self._file(self.root)
            files.deleteOnExit(target)
        df.write.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._scratch_path = path
        self.saved.append(saved)
        return saved

    def _file(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def drop(self, *frames: DataFrame | None) -> None:
        """Delete tables that nothing reads any more."""
        for frame in frames:
            path = getattr(frame, "_scratch_path", None)
            if path:
                target, files = self._file(path)
                files.delete(target, True)

    def clear(self, *keep: DataFrame) -> None:
        """Delete all tables of this folder but those that a result still reads."""
        kept = {getattr(frame, "_scratch_path", None) for frame in keep}
        self.drop(*(frame for frame in self.saved if frame._scratch_path not in kept))
        self.saved = list(keep)
