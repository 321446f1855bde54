"""Group statistics on rows, without collecting a group into one task.

A window function ships every row of a group to one task. Where a group can be
large, the statistic is aggregated (with map-side combining) and joined back:
only the small per-group result moves, and a hot group stays spread out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions import round_stable, safe_ratio
from quotelake.operators.joins import attach


def attach_group_stats(df: DataFrame, by: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    """``aggregate OVER (PARTITION BY by)`` as an aggregation joined back."""
    if not by:
        raise ValueError("group columns are required")
    stats = df.groupBy(*by).agg(*[agg.alias(name) for name, agg in aggregates.items()])
    return attach(df, stats, by)


def _z(value: Column, mean: Column, deviation: Column, digits: int) -> Column:
    return round_stable((value - mean) / F.nullif(deviation, F.lit(0.0)), digits)


def zscore(
    df: DataFrame,
    cols: Mapping[str, str],
    by: Sequence[str],
    digits: int = 2,
    small_groups: bool = False,
    sample: Column | None = None,
) -> DataFrame:
    """Add ``(x - mean) / sample deviation`` per group for each ``cols`` entry.

    ``cols`` maps output names to input columns. A group of one row, or of
    equal values, gives NULL. ``small_groups`` uses one window instead of the
    join: right when the group size is bounded by what the rows mean (the
    strikes listed for one expiry). With ``sample`` only the rows that satisfy
    it count towards mean and deviation.
    """
    members = {src: F.col(src) if sample is None else F.when(sample, F.col(src)) for src in cols.values()}
    means = {out: F.avg(members[src]) for out, src in cols.items()}
    deviations = {out: F.stddev_samp(members[src]) for out, src in cols.items()}
    if small_groups:
        group = Window.partitionBy(*by)
        return df.withColumns(
            {
                out: _z(F.col(src).cast("double"), means[out].over(group), deviations[out].over(group), digits)
                for out, src in cols.items()
            }
        )
    aggregates = {f"__mean_{out}": mean for out, mean in means.items()}
    aggregates |= {f"__dev_{out}": deviation for out, deviation in deviations.items()}
    scored = attach_group_stats(df, by, aggregates).withColumns(
        {
            out: _z(F.col(src).cast("double"), F.col(f"__mean_{out}"), F.col(f"__dev_{out}"), digits)
            for out, src in cols.items()
        }
    )
    return scored.drop(*aggregates)


def share_of_partition(
    df: DataFrame,
    by: Sequence[str],
    shares: Mapping[str, tuple[Column, Column]],
    digits: int = 4,
) -> DataFrame:
    """Add, per output name, the part of the group's value that meets a predicate.

    ``shares`` maps a name to (predicate, value); an empty or zero group is 0.
    """
    aggregates = {}
    for name, (predicate, value) in shares.items():
        aggregates[f"__part_{name}"] = F.sum(F.when(predicate, value))
        aggregates[f"__all_{name}"] = F.sum(value)
    out = attach_group_stats(df, by, aggregates)
    return out.withColumns(
        {
            name: F.coalesce(safe_ratio(f"__part_{name}", f"__all_{name}", digits), F.lit(0.0))
            for name in shares
        }
    ).drop(*aggregates)


def value_neighbours(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    value: str,
    previous: str = "prev",
    following: str = "next",
    last: str = "last",
) -> DataFrame:
    """Previous, next and latest value along ``order`` within ``key``.

    ``df`` must already be reduced so that a key has one row per date (or few):
    then even a key with a third of all raw rows is bounded by the calendar.
    The latest value is the greatest one on the key's last ``order[0]``.
    """
    along = Window.partitionBy(*key).orderBy(*order)
    whole = Window.partitionBy(*key)
    return (
        df.withColumn("__last_day", F.max(order[0]).over(whole))
        .withColumns(
            {
                previous: F.lag(value).over(along),
                following: F.lead(value).over(along),
                last: F.max(F.when(F.col(order[0]) == F.col("__last_day"), F.col(value))).over(whole),
            }
        )
        .drop("__last_day")
    )


def latest_snapshot(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the latest date; on a partition column only that folder is read."""
    return df.where(F.col(date_col) == df.agg(F.max(date_col)).scalar())


def latest_flag(df: DataFrame, date_col: str, out: str) -> DataFrame:
    """'Y' on rows of the latest date. The maximum is one scalar, no window."""
    newest = df.agg(F.max(date_col)).scalar()
    return df.withColumn(out, F.when(F.col(date_col) == newest, "Y").otherwise("N"))
