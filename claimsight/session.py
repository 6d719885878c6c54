"""Session settings and the shared work folder.

Nothing in the library creates a session: the caller does, usually with
``configure(SparkSession.builder)``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

#: Shuffle files go when the query that wrote them has ended, not when the driver happens to collect
#: its garbage. A stage whose files are wanted again is run again by Spark.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SETTINGS = {
    CLEANUP: "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": STATE_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(builder):
    """Add the settings the library expects to a session builder."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the same options on a session someone else has made."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package although it is not installed."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def work_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may leave that unset
    and gets a temporary folder of its machine; elsewhere other machines would not see it.
    """
    share_package(spark)
    spark.conf.set(CLEANUP, "true")
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("name a shared folder in spark.checkpoint.dir")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="claimsight-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the work folder."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` the work folder if it has none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_root(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the work folder, for results that are used again."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class WorkTables:
    """Intermediate tables of one operator, removed together when they are no longer read."""

    def __init__(self):
        self.held: list[tuple[SparkSession, str]] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        """The frame as a table in the work folder, like :func:`materialize`."""
        path = work_path(df.sparkSession, name)
        self.held.append((df.sparkSession, path))
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)

    def remove(self) -> None:
        """Remove all tables so far; frames that read them can no longer be used."""
        for spark, path in self.held:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.held.clear()
