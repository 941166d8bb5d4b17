"""Making a session ready: the package on the executors, and batches of bounded size for Python."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_files: set[tuple[str, str]] = set()

#: Bytes of rows that one Arrow batch to a Python worker holds, so that long texts don't add up there.
BATCH_BYTES = 16 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's source to the executors, once for each application, and bound Arrow batches.

    Functions that run on executors are pickled by reference, so the executors
    must be able to import the package; Spark's file server carries one archive.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        handle, name = tempfile.mkstemp(prefix="lodestar-", suffix=".zip")
        os.close(handle)
        with zipfile.ZipFile(name, "w") as archive:
            for source in sorted(root.rglob("*.py")):
                archive.write(source, source.relative_to(root.parent))
        spark.sparkContext.addPyFile(name)
        _shipped.add(app)
    return spark


def ship_file(spark: SparkSession, path: str) -> str:
    """Send a file to the executors, once for each application; its name, under which ``SparkFiles.get`` finds it there."""
    app = spark.sparkContext.applicationId
    if (app, path) not in _files:
        spark.sparkContext.addFile(path)
        _files.add((app, path))
    return os.path.basename(path)
