"""Session settings the operators are written for."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Adaptive execution does the run-time part of every plan here: it turns a
# shuffled join into a broadcast one once the measured side is small enough, and
# splits the partition of a hot join key. The force flag lets it split even where
# that costs one more exchange further up.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "tradewind", master: str | None = None, **conf: str) -> SparkSession:
    """A session with SETTINGS; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# Bytes a shuffle partition should hold before adaptive execution merges small ones.
PARTITION_BYTES = 200 * 1024 ** 2
# Compressed bytes of a shuffle that a task of the relational queries takes at most, key skew aside. Joins and
# aggregates hold some 40 times as much in memory: rows of repeated texts and keys compress well.
TASK_BYTES = 8 * 1024 ** 2
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def tune(spark: SparkSession, shuffle_bytes: int | None = None, task_bytes: int | None = None) -> SparkSession:
    """Apply SETTINGS to a session somebody else built (all are run-time settings).

    `shuffle_bytes`, the size of the largest shuffle to expect, raises the number of
    shuffle partitions so that a partition fits in the memory of a task. Adaptive
    execution merges them again where a shuffle turns out smaller. With `task_bytes` it
    merges to no more than these, and there are partitions enough for it: what a task
    holds then stays the same whatever the size of the tables.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if task_bytes is not None:
        advised = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_ADVISORY))
        spark.conf.set(_ADVISORY, f"{min(advised, task_bytes)}b")
    if shuffle_bytes is not None:
        partition_bytes = PARTITION_BYTES if task_bytes is None else 2 * task_bytes
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shuffle_bytes // partition_bytes))
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return spark


def input_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all files below a folder, in whatever store Spark reads it from."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the Python workers of this application the library, once; they import it by name."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        # The driver serves the archive to the executors for as long as it runs.
        folder = tempfile.mkdtemp(prefix="package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = Path(folder) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark
