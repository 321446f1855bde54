"""What the operators share: scratch tables, numbering without a global task, text in task batches."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotelake.session import shared_folder

# A-Z to a-z and nothing else, for UTF-8 bytes.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def trim() -> None:
    """Give the pages that this process has freed back to the machine, where its C library can."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


_claimed: dict[str, Callable[[], object]] = {}


def claim(owner: str, clear: Callable[[], object]) -> None:
    """Empty what other operators keep in this worker process between tasks."""
    others = [n for n in _claimed if n != owner]
    for name in others:
        _claimed.pop(name)()
    if others:
        gc.collect()
        trim()
    _claimed[owner] = clear


def nothing() -> None:
    """For operators that keep nothing."""


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back.

    This cuts the lineage so that it survives a lost executor, and pins what a
    second evaluation could number or split differently.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it (installed, shipped or a folder)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    salt: Column,
    salts: int,
    name: str,
) -> DataFrame:
    """A gapless number from 0 within ``keys``, without one task per key.

    Rows of a key are dealt to ``salts`` blocks; the numbers run through the
    blocks in turn. Only the block sizes meet in one window. ``df`` is read
    twice and must give the same rows each time (a materialized table).
    """
    salted = df.withColumn("__salt", F.pmod(salt, F.lit(salts)).cast("int"))
    sizes = salted.groupBy(*keys, "__salt").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__salt").alias("__s"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
    )
    block = Window.partitionBy(*keys, "__salt").orderBy(*order)
    ranked = salted.withColumn("__rank", F.row_number().over(block))
    on = F.col("__salt") == F.col("__s")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    number = (F.col("__before") + F.col("__rank") - 1).alias(name)
    return ranked.join(sizes, on).select(*df.columns, number)


def blocks_for(rows: int, per_block: int = 20_000) -> int:
    return max(1, -(-rows // per_block))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def regroup(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one stay near ``max_bytes``; at least one row each."""
    for batch in batches:
        # From the offsets: a batch's texts are not copied at once.
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
