"""The incremental ingest as a file stream.

The stream's checkpoint takes the place of the list of processed dates: each
run takes the files it has not seen, then stops. A batch appends a folder of its
own below each date it has rows of, named by its number: what is written is
what came, however often a date is added to, and a batch repeated after a
failure writes its folders anew. ``compact`` merges the folders of a date that
has many into one named by the batches it covers ('0-7'), then removes those;
readers pass over a folder that another one covers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.sources.files import file_date, with_row_id
from quotelake.sources.lake import PARTITION, list_partitions, read_partitioned

BATCH = "ingest_batch"
MOST_FOLDERS = 8


def append_batch(rows: DataFrame, batch_id: int, target: str, col: str = PARTITION) -> None:
    """The rows of a batch to folders of its own; the same batch again replaces them."""
    _write(rows.withColumn(BATCH, F.lit(str(batch_id))), target, col)


def _write(rows: DataFrame, target: str, col: str) -> None:
    writer = rows.hint("rebalance", col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(col, BATCH).parquet(target)


def _span(name: str) -> tuple[int, int]:
    first, _, last = name.partition("-")
    return int(first), int(last or first)


def committed_batches(
    spark: SparkSession, target: str, values: Iterable[str] | None = None, col: str = PARTITION
) -> dict[str, list[str]]:
    """The batch folders of each date that count, in order."""
    found = {}
    for value in list_partitions(spark, target, col) if values is None else values:
        spans = {_span(n): n for n in list_partitions(spark, f"{target}/{col}={value}", BATCH)}
        found[value] = [
            name
            for span, name in sorted(spans.items())
            if not any(o != span and o[0] <= span[0] and span[1] <= o[1] for o in spans)
        ]
    return found


def read_committed(
    spark: SparkSession, target: str, values: Iterable[str] | None = None, col: str = PARTITION
) -> DataFrame:
    """The rows of the committed batches; also right while a compaction runs or after one that broke off."""
    batches = committed_batches(spark, target, values, col)
    folders = [f"{target}/{col}={value}/{BATCH}={name}" for value, names in batches.items() for name in names]
    if not folders:
        return read_partitioned(spark, target, col, [])
    return spark.read.option("basePath", target).parquet(*folders).withColumn(col, F.col(col).cast("string"))


def compact(spark: SparkSession, target: str, most: int = MOST_FOLDERS, col: str = PARTITION) -> list[str]:
    """Merge the folders of the dates that have more than ``most``; returns those dates.

    What a compaction before this one left behind is removed as well.
    """
    batches = committed_batches(spark, target, col=col)
    merged = {value: f"{_span(names[0])[0]}-{_span(names[-1])[1]}" for value, names in batches.items() if len(names) > most}
    if merged:
        name = F.create_map(*[F.lit(x) for pair in merged.items() for x in pair])[F.col(col)]
        _write(read_committed(spark, target, list(merged), col).withColumn(BATCH, name), target, col)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for value, names in committed_batches(spark, target, col=col).items():
        for covered in set(list_partitions(spark, f"{target}/{col}={value}", BATCH)) - set(names):
            fs.delete(path(f"{target}/{col}={value}/{BATCH}={covered}"), True)
    return sorted(merged)


def stream_partitions(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    col: str = PARTITION,
) -> None:
    """Drain a streaming frame into a partitioned table and stop."""

    def add(batch: DataFrame, batch_id: int) -> None:
        append_batch(transform(batch) if transform else batch, batch_id, target, col)

    query = (
        rows.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_csv_to_raw(spark: SparkSession, folder: str, schema: T.StructType, target: str, checkpoint: str) -> None:
    """New CSV files of ``folder`` to the raw table, each date in as many files as
    arrive. The layout must be that of ``schema``: another header fails."""
    files = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(folder)
    )
    dated = files.select("*", file_date().alias(PARTITION))
    stream_partitions(dated, target, checkpoint, with_row_id)
