"""Tables written between two passes over the same intermediate result.

A staged table cuts the lineage: a lost executor costs re-reading a few files,
not re-running the joins in front of them. Unlike `DataFrame.checkpoint` it is
columnar, so a later pass reads only the columns it needs, and its file sizes give
the planner true statistics. What was shuffled to make it is of no more use once it is
written, and its files are removed then, rather than when the driver collects its garbage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only on a local master without a setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tradewind-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return f"{configured.rstrip('/')}/tradewind/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _without_shuffles_kept(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is executed meanwhile are removed at its end."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` as Parquet in the shared folder and return a scan of it."""
    path = new_path(df.sparkSession, name)
    with _without_shuffles_kept(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
