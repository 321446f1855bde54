"""Date-partitioned tables whose files are bucketed by a key, so that joins and groupings by it need no shuffle."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quotelake.session import shuffles_end_with_writes
from quotelake.sources.lake import PARTITION, path_exists, replace_partitions


@dataclass(frozen=True)
class BucketedTable:
    """A catalog table over Parquet folders, one per partition value, each of ``buckets`` files.

    A scan of it is hash-partitioned by ``by``, and one task reads a bucket of
    all the dates asked for. So the table should hold reduced rows, with a key
    that no third of them shares; tables that are joined take one number of
    buckets. Bucketing lives in the catalog: a session with another catalog
    calls ``create`` again over the same folders.
    """

    name: str
    path: str
    by: str
    buckets: int
    partition: str = PARTITION
    compression: str = "snappy"

    def create(self, spark: SparkSession, schema: T.StructType) -> None:
        if spark.catalog.tableExists(self.name):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet PARTITIONED BY ({self.partition}) "
            f"CLUSTERED BY ({self.by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}' "
            # Inserts take these from the table, not from the writer.
            f"OPTIONS (partitionOverwriteMode 'dynamic', compression '{self.compression}')"
        )
        if path_exists(spark, self.path):
            spark.catalog.recoverPartitions(self.name)

    def replace(self, df: DataFrame, values: Iterable[str]) -> None:
        """Write partition values anew; those without rows in ``df`` lose their old ones.

        Rows meet their bucket before the write, so a bucket of a date is one file.
        """
        spark = df.sparkSession
        self.create(spark, df.schema)

        def insert(rows: DataFrame) -> None:
            columns = [c for c in rows.columns if c != self.partition]
            placed = rows.repartition(self.buckets, self.by).select(*columns, self.partition)
            with shuffles_end_with_writes(spark):
                placed.write.mode("overwrite").insertInto(self.name)

        replace_partitions(df, self.path, values, self.partition, write=insert)
        spark.catalog.refreshTable(self.name)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)
