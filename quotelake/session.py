"""Session builder and the folder for data that must survive executor loss."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What the lake needs from a session: strict casts, dates kept as the strings
# they are stored under, partition-wise overwrite and run-time re-planning.
LAKE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Plans of hundreds of columns are built in Python; do not record a call
    # site for every expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The JVM interprets methods above 8000 bytes. Wide products exceed that
    # when fused into one method; they run faster as several.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app: str = "quotelake", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session; ``master`` is only set for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
        )
    for key, value in {**LAKE_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the cluster's checkpoint folder.

    Only when the cluster names none (a local test) is a machine folder used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        base = tempfile.mkdtemp(prefix="quotelake-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def compile_wide_rows(spark: SparkSession) -> None:
    """Set the limit above on a session that was not built here: the flow report's rows are that wide."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(limit, LAKE_CONF[limit])


@contextmanager
def shuffles_end_with_writes(spark: SparkSession) -> Iterator[None]:
    """Writes in here give their shuffle files back as they end.

    Spark keeps them until the driver's garbage collection comes upon the plan,
    so the steps of a job that writes one table after the other add up on disk.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partitions_for(df: DataFrame, rows_per_task: int) -> int:
    """Partitions that hold about ``rows_per_task`` rows each, the session's number at least.

    Run-time coalescing goes by compressed bytes, of which narrow rows that a
    task multiplies or keeps in hash tables have few. Counting reads no column
    of stored Parquet. Less than the session's number would be dealt anew by a join.
    """
    return max(shuffle_partitions(df.sparkSession), -(-df.count() // rows_per_task))
