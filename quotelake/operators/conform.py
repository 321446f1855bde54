"""Fit a frame to a target schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def conform(
    df: DataFrame,
    target: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
    missing: str | None = None,
    keep_available_only: bool = False,
) -> DataFrame:
    """Rename, then select ``target`` in order.

    Unmapped columns pass through a rename. With a target list, extra columns
    are dropped and absent ones are filled with ``missing`` (NULL or ''), or
    left out when ``keep_available_only``.
    """
    if rename:
        df = df.withColumnsRenamed({old: new for old, new in rename.items() if old in df.columns})
    if target is None:
        return df
    present = set(df.columns)
    if keep_available_only:
        return df.select(*[c for c in target if c in present])
    filler = F.lit(missing).cast("string")
    return df.select(*[F.col(f"`{c}`") if c in present else filler.alias(c) for c in target])


def add_literal(df: DataFrame, **values: str) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def stack_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; a column a frame lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
