"""Date-partitioned Parquet tables: reading, replacing, and what is pending."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.session import shuffles_end_with_writes

PARTITION = "file_version_date"


def read_partitioned(
    spark: SparkSession,
    path: str,
    partition_col: str = PARTITION,
    values: Iterable[str] | None = None,
) -> DataFrame:
    """Scan a table; with ``values`` only those folders are read.

    The partition value is text ('20250131'), also where the session would
    guess a number.
    """
    folders = [path]
    if values is not None:
        values = list(values)
        there = set(list_partitions(spark, path, partition_col))
        # Only the folders asked for are listed; none of them there: an empty frame of the table.
        folders = [f"{path}/{partition_col}={v}" for v in values if v in there] or [path]
    df = spark.read.option("basePath", path).parquet(*folders)
    df = df.withColumn(partition_col, F.col(partition_col).cast("string"))
    return df if values is None else df.where(F.col(partition_col).isin(values))


def list_partitions(spark: SparkSession, path: str, partition_col: str = PARTITION) -> list[str]:
    """Sorted partition values, from one directory listing (no data is read)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    prefix = f"{partition_col}="
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(n[len(prefix) :] for n in names if n.startswith(prefix))


def partition_bytes(spark: SparkSession, path: str, value: str, partition_col: str = PARTITION) -> int:
    """Length of the files of a partition value, by the listing; 0 without a folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"{partition_col}={value}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(folder).getLength() if fs.exists(folder) else 0


def latest_partition(spark: SparkSession, path: str, partition_col: str = PARTITION) -> str | None:
    """Greatest 'YYYYMMDD' value; anything else is not a date."""
    dates = [v for v in list_partitions(spark, path, partition_col) if len(v) == 8 and v.isdigit()]
    return max(dates, default=None)


def read_latest(spark: SparkSession, path: str, partition_col: str = PARTITION) -> DataFrame:
    """The newest date of a table. The date comes from the listing, so no other folder is opened."""
    newest = latest_partition(spark, path, partition_col)
    return read_partitioned(spark, path, partition_col, [newest] if newest else [])


def pending_partitions(
    source: DataFrame,
    done: DataFrame,
    col: str = PARTITION,
    rerun: Sequence[str] = (),
) -> DataFrame:
    """Distinct source values not done yet; with ``rerun`` exactly those."""
    values = source.select(col).distinct()
    if rerun:
        return values.where(F.col(col).isin(list(rerun)))
    return values.join(done.select(col).distinct(), col, "left_anti")


def pending_values(source: Iterable[str], done: Iterable[str], rerun: Sequence[str] = ()) -> list[str]:
    """The same for partition values already listed (one per date)."""
    available = set(source)
    return sorted(available & set(rerun)) if rerun else sorted(available - set(done))


def write_partitions(
    df: DataFrame,
    path: str,
    col: str = PARTITION,
    compression: str = "snappy",
    mode: str = "overwrite",
    sort_by: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """One folder per value; ``overwrite`` replaces only the values in ``df``.

    The rebalance hint gathers a date's rows into well-sized files and splits a
    date that is too large for one task. With ``sort_by`` rows are placed by
    ranges of (date, sort columns) instead: the files of a date do not overlap,
    and the statistics of their row groups prune a filter on the first sort
    column. Small ranges are merged at run time unless ``files`` fixes their
    number.
    """
    rows = df.hint("rebalance", col)
    if sort_by:
        order = [F.col(col).asc(), *[F.col(c).asc_nulls_last() for c in sort_by]]
        rows = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
        rows = rows.sortWithinPartitions(*order)
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", compression)
    with shuffles_end_with_writes(df.sparkSession):
        writer.partitionBy(col).parquet(path)


def drop_partitions(spark: SparkSession, path: str, values: Iterable[str], col: str = PARTITION) -> None:
    """Remove the folders of values, where there are any."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for value in values:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{col}={value}"), True)


def replace_partitions(
    df: DataFrame,
    path: str,
    values: Iterable[str],
    col: str = PARTITION,
    compression: str = "snappy",
    sort_by: Sequence[str] = (),
    write: Callable[[DataFrame], None] | None = None,
) -> None:
    """Write ``values`` anew; those that have no rows in ``df`` lose their old ones.

    A folder that was written has other files than before. ``write`` stands in
    for ``write_partitions`` where a table has a layout of its own.
    """
    spark, values = df.sparkSession, list(values)
    before = {v: _file_names(spark, f"{path}/{col}={v}") for v in values}
    if write:
        write(df)
    else:
        write_partitions(df, path, col, compression, sort_by=sort_by)
    stale = [v for v, names in before.items() if names and names == _file_names(spark, f"{path}/{col}={v}")]
    drop_partitions(spark, path, stale, col)


def _file_names(spark: SparkSession, folder: str) -> set[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def processed_values(spark: SparkSession, ledger: str, col: str = PARTITION) -> set[str]:
    """What a ledger holds: one short row per date ever processed."""
    if not path_exists(spark, ledger):
        return set()
    return {r[0] for r in spark.read.parquet(ledger).select(col).distinct().collect()}


def write_table(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Replace an unpartitioned table."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def append_table(df: DataFrame, path: str, compression: str = "snappy") -> None:
    df.write.mode("append").option("compression", compression).parquet(path)


def record_processed(spark: SparkSession, ledger: str, values: Sequence[str], col: str = PARTITION) -> None:
    """Append processed values to a ledger, after their data is written."""
    rows = spark.createDataFrame([(v,) for v in values], f"{col} string")
    rows.coalesce(1).write.mode("append").parquet(ledger)
