"""Joins that treat NULL keys the way GROUP BY and PARTITION BY do."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``right`` (one row per key) to ``df`` with NULL keys matching.

    Spark turns the null-safe equality into a hashable key, so this is a plain
    equi-join: broadcast when AQE measures ``right`` small, otherwise
    sort-merge with skewed partitions split.
    """
    marked = right.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(marked[f"__key_{k}"]) for k in keys])
    return df.join(marked, on, how).drop(*[f"__key_{k}" for k in keys])


def keep_matching(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys occur in ``other``; never fans out."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def full_outer_merge(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Full outer join, the keys taken from whichever side has the row."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    # Own names for the right keys: both sides may come from one table.
    right = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__right_{k}") for k in keys])
    rest = {c: f"__right_{c}" for c in right.columns if c in left.columns}
    joined = left.join(right.withColumnsRenamed(rest), on, "full_outer")
    return joined.select(
        *[F.coalesce(k, f"__right_{k}").alias(k) for k in keys],
        *[c for c in left.columns if c not in keys],
        *[F.col(rest.get(c, c)).alias(c) for c in right.columns if not c.startswith("__right_")],
    )
