"""Incremental jobs over date partitions."""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quotelake.sources.buckets import BucketedTable
from quotelake.sources.files import file_manifest
from quotelake.sources.lake import (
    PARTITION,
    list_partitions,
    partition_bytes,
    path_exists,
    pending_values,
    processed_values,
    read_partitioned,
    record_processed,
    replace_partitions,
    write_table,
)

# Stored source files whose dates go through one Spark job. Its shuffle files, several times as many bytes, go when it ends.
BYTES_AT_ONCE = 512 << 20

log = logging.getLogger(__name__)

FILE_FIELDS = "source string, file string, length bigint, modified timestamp"


@dataclass
class _DatedJob:
    """Dates that are pending go through one Spark job, or a few where their sources are large.

    Only when one fails are its dates halved until the bad ones are found;
    those are logged and skipped. A date counts as done once it is in the
    ledger, with or without result rows (or, for targets older than their
    ledger, once it has a folder). A date that is written anew and has no rows
    any more loses its old ones.
    """

    sources: Mapping[str, object]
    transform: Callable[..., DataFrame]
    target: str
    partition_col: str = PARTITION
    ledger: str | None = None
    compression: str = "snappy"
    sort_by: Sequence[str] = ()
    failed: list[str] = field(default_factory=list)
    errors: list[Exception] = field(default_factory=list)
    writes: int = 0

    def _available(self, spark: SparkSession) -> Sequence[str]:
        raise NotImplementedError

    def _bytes(self, spark: SparkSession, value: str) -> int:
        """Length of the source files of a date."""
        raise NotImplementedError

    def _load(self, spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
        raise NotImplementedError

    @property
    def _ledger(self) -> str:
        # Readers of the table pass over names that begin so.
        return self.ledger or f"{self.target}/_processed"

    def _write(self, spark: SparkSession, values: Sequence[str]) -> None:
        self.writes += 1
        frames = {name: self._load(spark, name, values) for name in self.sources}
        self._replace(self.transform(**frames), values)
        self._record(spark, values)

    def _replace(self, result: DataFrame, values: Sequence[str]) -> None:
        replace_partitions(result, self.target, values, self.partition_col, self.compression, self.sort_by)

    def _record(self, spark: SparkSession, values: Sequence[str]) -> None:
        record_processed(spark, self._ledger, values, self.partition_col)

    def _attempt(self, spark: SparkSession, values: list[str]) -> list[str]:
        try:
            self._write(spark, values)
            return values
        except Exception as error:  # noqa: BLE001 - a bad date must not stop the others
            if len(values) == 1:
                log.error("partition %s failed: %s", values[0], error)
                self.failed += values
                self.errors.append(error)
                return []
            log.warning("%d partitions failed together, halving them", len(values))
        half = len(values) // 2
        return self._attempt(spark, values[:half]) + self._attempt(spark, values[half:])

    def _in_turn(self, spark: SparkSession, todo: Sequence[str]) -> list[str]:
        """All of ``todo``, as many dates at a time as have ``BYTES_AT_ONCE`` of source files; one at least."""
        processed, group, held = [], [], 0
        for value in todo:
            size = self._bytes(spark, value)
            if group and held + size > BYTES_AT_ONCE:
                processed += self._attempt(spark, group)
                group, held = [], 0
            group.append(value)
            held += size
        return processed + self._attempt(spark, group) if group else processed

    def run(self, spark: SparkSession, rerun: Sequence[str] = ()) -> list[str]:
        """Process what is pending (or ``rerun``); returns the values processed."""
        self.failed, self.errors, self.writes = [], [], 0
        done = processed_values(spark, self._ledger, self.partition_col)
        if self.ledger is None:
            done |= set(list_partitions(spark, self.target, self.partition_col))
        todo = pending_values(self._available(spark), done, rerun)
        return self._in_turn(spark, todo)

    def run_whole(self, spark: SparkSession, rerun: Sequence[str] = ()) -> list[str]:
        """``run`` for callers that read the target as a whole: raises when a date failed, after the others are done."""
        processed = self.run(spark, rerun)
        if self.failed:
            raise RuntimeError(f"{self.target} lacks {', '.join(self.failed)}") from self.errors[0]
        return processed


@dataclass
class PartitionedJob(_DatedJob):
    """Apply a DataFrame function to the partitions a target does not have yet.

    ``sources`` maps argument names of ``transform`` to table paths; the first
    one decides which partitions exist. Only pending folders are read.
    """

    def _available(self, spark: SparkSession) -> Sequence[str]:
        return list_partitions(spark, next(iter(self.sources.values())), self.partition_col)

    def _bytes(self, spark: SparkSession, value: str) -> int:
        return sum(partition_bytes(spark, path, value, self.partition_col) for path in self.sources.values())

    def _load(self, spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
        return read_partitioned(spark, self.sources[name], self.partition_col, values)


@dataclass
class BucketedJob(PartitionedJob):
    """The same into a table bucketed by a key of the result. The table's folder is the target."""

    table: BucketedTable | None = None

    def _replace(self, result: DataFrame, values: Sequence[str]) -> None:
        self.table.replace(result, values)


@dataclass
class FileFeedJob(_DatedJob):
    """The same for vendor files whose names end in their date.

    ``sources`` maps argument names of ``transform`` to (paths, reader); a
    reader takes (spark, files) and returns a frame with the date column, and
    ``transform`` gets None for a source without a file of the dates at hand.

    A date exists when any source has a file of it, and every ``required`` one.
    A manifest beside the target keeps the files that made each date, with
    their lengths and modification times. A date without entries is pending;
    with ``follow_changes`` also one whose files are not those any more: a file
    came late, was corrected or was taken away while others stay. Files that
    all went (an archive) change nothing. Dates that a list of processed dates
    has and the manifest has not are from before the manifest, and done. Only
    files of pending dates are opened.
    """

    required: Sequence[str] = ()
    follow_changes: bool = False

    @property
    def _manifest(self) -> str:
        return f"{self.ledger or self.target}/_files"

    def _current(self, spark: SparkSession) -> DataFrame:
        """Every file of the dates that exist."""
        col = self.partition_col
        found = [
            file_manifest(spark, paths, col=col).withColumn("source", F.lit(name))
            for name, (paths, _) in self.sources.items()
        ]
        files = reduce(DataFrame.unionByName, found)
        if not self.required:
            return files
        whole = files.where(F.col("source").isin(list(self.required))).groupBy(col)
        whole = whole.agg(F.countDistinct("source").alias("n")).where(F.col("n") == len(set(self.required)))
        return files.join(whole, col, "left_semi")

    def _recorded(self, spark: SparkSession) -> DataFrame | None:
        """The files of the last time each date was written."""
        if not path_exists(spark, self._manifest):
            return None
        col = self.partition_col
        entries = spark.read.schema(f"{col} string, {FILE_FIELDS}, run bigint").parquet(self._manifest)
        last = entries.groupBy(col).agg(F.max("run").alias("run"))
        self._last_run = last.agg(F.max("run")).first()[0] or 0
        return entries.join(last, [col, "run"]).drop("run")

    def _pending(self, spark: SparkSession, rerun: Sequence[str]) -> DataFrame:
        """Files of the dates to process."""
        col = self.partition_col
        files, recorded = self._current(spark), self._recorded(spark)
        if rerun:
            return files.where(F.col(col).isin(list(rerun)))
        before = processed_values(spark, self._ledger, col)
        if recorded is None:
            if not before and self.ledger is None:
                before = set(list_partitions(spark, self.target, col))
            return files.where(~F.col(col).isin(sorted(before)))
        if self.follow_changes:
            fields = [col, "source", "file", "length", "modified"]
            new = files.select(fields).exceptAll(recorded.select(fields))
            gone = recorded.select(fields).exceptAll(files.select(fields))
            changed = new.select(col).union(gone.select(col)).distinct()
        else:
            changed = files.join(recorded, col, "left_anti").select(col).distinct()
        older = spark.createDataFrame([(v,) for v in before], f"{col} string")
        changed = changed.join(older.join(recorded, col, "left_anti"), col, "left_anti")
        return files.join(changed, col, "left_semi")

    def _available(self, spark: SparkSession) -> Sequence[str]:
        return sorted(self._files)

    def _bytes(self, spark: SparkSession, value: str) -> int:
        return sum(r["length"] for r in self._files[value])

    def run(self, spark: SparkSession, rerun: Sequence[str] = ()) -> list[str]:
        """Process what is pending (or ``rerun``); returns the values processed."""
        self.failed, self.errors, self.writes, self._last_run = [], [], 0, 0
        self._files: dict[str, list[Row]] = defaultdict(list)
        # One row per file of a pending date.
        for row in self._pending(spark, rerun).collect():
            self._files[row[self.partition_col]].append(row)
        todo = list(self._available(spark))
        return self._in_turn(spark, todo)

    def _load(self, spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame | None:
        """None where a source has no file of these dates."""
        files = [r["file"] for value in values for r in self._files[value] if r["source"] == name]
        return self.sources[name][1](spark, sorted(files)) if files else None

    def _record(self, spark: SparkSession, values: Sequence[str]) -> None:
        # As listed before they were read: a file that changed meanwhile is pending again.
        rows = [
            (value, r["source"], r["file"], r["length"], r["modified"], self._last_run + self.writes)
            for value in values
            for r in self._files[value]
        ]
        entries = spark.createDataFrame(rows, f"{self.partition_col} string, {FILE_FIELDS}, run bigint")
        entries.coalesce(1).write.mode("append").parquet(self._manifest)


def refresh_table(sources: Mapping[str, DataFrame], transform: Callable[..., DataFrame], target: str) -> None:
    """Recompute a whole table from all partitions of its sources."""
    write_table(transform(**sources), target)
