"""Session settings and the shared folder that jobs write scratch tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on. AQE splits skewed join partitions and skewed
# rebalance partitions; forcing the skewed join accepts one more shuffle in exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


# Spark's own setting; versions without it ignore it.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it, each query's shuffle files go when the query ends, not when the driver happens to
    collect its garbage: steps that write one after another need the disk of the largest one only.
    A frame collected twice shuffles twice."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def shared_dir(spark: SparkSession) -> str:
    """A fresh path below the folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a temporary folder, once. On a
    cluster such a folder would be a different one on each machine, so the setting is needed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not is_local(master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder: the master is {master}")
        root = _local_roots.get(spark.sparkContext.applicationId)
        if root is None:
            root = tempfile.mkdtemp(prefix="martloom-")
            _local_roots[spark.sparkContext.applicationId] = root
            spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def is_local(master: str) -> bool:
    """Whether driver and executors are one process and so see the same folders."""
    return master == "local" or master.startswith("local[")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut in the lineage that outlives
    executors, and a source that no longer depends on the files ``df`` was read from."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_local_roots: dict[str, str] = {}
