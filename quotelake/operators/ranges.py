"""Ordered work over groups of any size: rows are dealt to ranges of (group, order), and ranges carry to each other.

A window over a group puts it in one task. Here Spark samples splitters and
sorts rows into ranges, so a group with a third of all rows spans many; what a
range needs from the others is one row per group and range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.operators.joins import attach
from quotelake.session import shared_folder

BLOCK = "__block"


def range_blocks(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """The rows with the number of their range in ``__block``; ranges follow one another, NULLs last.

    Rows that agree on ``order`` share a range. The splitters are sampled, so the
    rows are written once and every later step sees the same ranges, also after
    an executor is lost. Without ``parts`` small ranges are merged at run time.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    laid = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    path = shared_folder(df.sparkSession, "ranges")
    numbered = laid.withColumn(BLOCK, F.spark_partition_id())
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path)


def ranged_neighbours(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    value: str,
    previous: str = "prev",
    following: str = "next",
    last: str = "last",
    parts: int | None = None,
) -> DataFrame:
    """``value_neighbours`` for keys of any size.

    Neighbours inside a range come from a window over (key, range); the first
    and last row of a range take theirs from the edges of the ranges before and
    after, of which a key has one row each. Rows that tie on ``order`` follow
    one another by ``value``.
    """
    blocks = range_blocks(df, [*key, *order], parts)
    along = Window.partitionBy(*key, BLOCK).orderBy(*[F.col(c).asc_nulls_last() for c in [*order, value]])
    # NULLs are marked so that the least and greatest struct are the first and last row.
    place = [x for c in [*order, value] for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(f"at_{c}"))]
    edges = blocks.groupBy(*key, BLOCK).agg(
        F.min(F.struct(*place)).alias("__head"),
        F.max(F.struct(*place)).alias("__tail"),
        F.max(F.when(F.col(order[0]).isNotNull(), F.struct(F.col(order[0]).alias("at"), F.col(value).alias("v")))).alias("__newest"),
    )
    whole = Window.partitionBy(*key)
    by_block = whole.orderBy(BLOCK)
    carried = edges.select(
        *key,
        BLOCK,
        F.lag(f"__tail.at_{value}").over(by_block).alias("__before"),
        F.lead(f"__head.at_{value}").over(by_block).alias("__after"),
        F.max("__newest").over(whole)["v"].alias(last),
    )
    rows = blocks.withColumns(
        {
            "__first": F.row_number().over(along) == 1,
            "__final": F.lead(F.lit(True)).over(along).isNull(),
            previous: F.lag(value).over(along),
            following: F.lead(value).over(along),
        }
    )
    rows = attach(rows, carried, [*key, BLOCK])
    return rows.select(
        *df.columns,
        F.when(F.col("__first"), F.col("__before")).otherwise(F.col(previous)).alias(previous),
        F.when(F.col("__final"), F.col("__after")).otherwise(F.col(following)).alias(following),
        last,
    )
