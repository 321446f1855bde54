"""Ranks within large groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions import round_scaled
from quotelake.operators.joins import attach
from quotelake.operators.ranges import BLOCK, range_blocks

def _window_rank(value: Column, by: Sequence[str], digits: int, null_metric: str) -> Column:
    peers = Window.partitionBy(*by)
    if null_metric == "last":
        return round_scaled(F.percent_rank().over(peers.orderBy(value.asc_nulls_last())), digits)
    # Nulls sort last, so they only count in the number of peers.
    below = F.rank().over(peers.orderBy(value.asc_nulls_last())) - 1
    others = F.count(value).over(peers) - 1
    rank = F.when(others == 0, F.lit(0.0)).otherwise(below / F.nullif(others, F.lit(0)))
    return F.when(value.isNotNull(), round_scaled(rank, digits))


def peer_percentile(
    df: DataFrame,
    cols: Mapping[str, str],
    by: Sequence[str],
    key: Sequence[str],
    digits: int = 4,
    null_metric: str = "last",
    small_groups: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Add ``PERCENT_RANK() OVER (PARTITION BY by ORDER BY x)`` per metric.

    ``cols`` maps output names to metrics and ``key`` identifies a row. A
    window would sort each group in one task, once per metric. Here all metrics
    go through the same distributed steps: count the rows per distinct value,
    deal the values to ranges by sampled splitters, add up the ranges before
    (few per group), rank the distinct values inside a range, and look every
    row's value up. Ties and hot values collapse in the first step, and a dense
    stretch of values spans many ranges. ``parts`` fixes their number.

    A NULL metric ranks above all values (``null_metric="last"``) or gets no
    percentile and is not a peer (``"ignore"``). ``small_groups`` is for groups
    that something else bounds (the tickers of a sector on a day): windows over
    one placement of the rows.
    """
    if null_metric not in ("last", "ignore"):
        raise ValueError("null_metric is 'last' or 'ignore'")
    outputs = list(cols)
    if small_groups:
        return df.withColumns({out: _window_rank(F.col(cols[out]).cast("double"), by, digits, null_metric) for out in outputs})
    pairs = [
        F.struct(F.lit(i).alias("__metric"), F.col(cols[out]).cast("double").alias("__value"))
        for i, out in enumerate(outputs)
    ]
    long = df.select(*by, *key, F.inline(F.array(*pairs)))
    if null_metric == "ignore":
        long = long.where(F.col("__value").isNotNull())

    metric = [*by, "__metric"]
    span = [*metric, BLOCK]
    values = long.groupBy(*metric, "__value").agg(F.count(F.lit(1)).alias("__n"))
    values = range_blocks(values, [*metric, "__value"], parts)
    ranges = values.groupBy(*span).agg(F.sum("__n").alias("__range_n"))
    whole = Window.partitionBy(*metric)
    earlier_ranges = whole.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        *span,
        F.coalesce(F.sum("__range_n").over(earlier_ranges), F.lit(0)).alias("__before"),
        F.sum("__range_n").over(whole).alias("__peers"),
    )
    earlier_values = (
        Window.partitionBy(*span).orderBy(F.col("__value").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    )
    below = F.col("__before") + F.coalesce(F.sum("__n").over(earlier_values), F.lit(0))
    peers = F.col("__peers") - 1
    ranks = attach(values, offsets, span).select(
        *metric,
        "__value",
        F.when(peers == 0, F.lit(0.0)).otherwise(below / F.nullif(peers, F.lit(0))).alias("__pct"),
    )
    looked_up = attach(long, ranks, [*metric, "__value"])
    wide = looked_up.groupBy(*key).agg(
        *[
            round_scaled(F.max(F.when(F.col("__metric") == i, F.col("__pct"))), digits).alias(out)
            for i, out in enumerate(outputs)
        ]
    )
    return attach(df, wide, key, "left" if null_metric == "ignore" else "inner")


def dense_rank_of_distinct(df: DataFrame, by: Sequence[str], order: str, out: str) -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY by ORDER BY order)``.

    Ranks the distinct values of a group and looks them up, so repeated values
    (weeks of a symbol) never gather in one task. NULL ranks last.
    """
    ranks = (
        df.select(*by, order)
        .distinct()
        .withColumn(out, F.dense_rank().over(Window.partitionBy(*by).orderBy(F.col(order).asc_nulls_last())))
    )
    return attach(df, ranks, [*by, order])
