"""CUBE over pre-aggregated leaves."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions import round_stable


@dataclass(frozen=True)
class Measure:
    """An aggregate that can be computed from partial results."""

    name: str
    leaf: Column
    merge: Callable[[str], Column]


@dataclass(frozen=True)
class WeightedAverage:
    """``sum(value * weight) / sum(weight)``, rounded.

    A NULL value leaves the numerator but not the denominator. ``weight_total``
    names the measure that holds ``sum(weight)``.
    """

    name: str
    value: Column
    weight: Column
    weight_total: str
    digits: int

    @property
    def part(self) -> str:
        return f"__sum_{self.name}"

    def as_measure(self) -> Measure:
        return Measure(self.part, F.sum(self.value * self.weight), F.sum)

    def final(self) -> Column:
        weight = F.nullif(F.col(self.weight_total).cast("double"), F.lit(0.0))
        return round_stable(F.col(self.part) / weight, self.digits)


def count_rows(name: str) -> Measure:
    return Measure(name, F.count(F.lit(1)), F.sum)


def total(name: str, value: Column) -> Measure:
    return Measure(name, F.sum(value), F.sum)


def lowest(name: str, value: Column) -> Measure:
    return Measure(name, F.min(value), F.min)


def highest(name: str, value: Column) -> Measure:
    return Measure(name, F.max(value), F.max)


def cube_leaves(
    df: DataFrame,
    keys: Sequence[str],
    cube_cols: Sequence[str],
    measures: Sequence[Measure],
    averages: Sequence[WeightedAverage] = (),
) -> DataFrame:
    """One row per (keys, cube_cols): what ``cube_of_leaves`` needs, and what a stage table may keep."""
    parts = [*measures, *[a.as_measure() for a in averages]]
    return df.groupBy(*keys, *cube_cols).agg(*[m.leaf.alias(m.name) for m in parts])


def cube_agg(
    df: DataFrame,
    keys: Sequence[str],
    cube_cols: Sequence[str],
    measures: Sequence[Measure],
    averages: Sequence[WeightedAverage] = (),
    on_leaves: Callable[[DataFrame], DataFrame] | None = None,
    distribute_by: Sequence[str] | None = None,
    grouping_col: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``GROUP BY keys, CUBE(cube_cols)``.

    The rows are first reduced to one per (keys, cube_cols) with map-side
    combining, and only those leaves are multiplied by the grouping sets, so
    the raw rows cross the network once and are never expanded. ``on_leaves``
    may filter the leaves (totals per key can be had from them). When
    ``distribute_by`` (a subset of ``keys`` with a bounded number of rows each)
    is given, the rows are placed by it instead, and neither the leaves nor the
    final aggregation are shuffled: right where most rows are leaves of their
    own, which combining would send as wider rows and then a second time. A task
    then holds leaves and sets of its rows, so ``partitions`` should bound those.
    """
    rows = df
    if distribute_by:
        rows = df.repartition(*([partitions] if partitions else []), *distribute_by)
    leaves = cube_leaves(rows, keys, cube_cols, measures, averages)
    if on_leaves:
        leaves = on_leaves(leaves)
    return cube_of_leaves(leaves, keys, cube_cols, measures, averages, grouping_col)


def cube_of_leaves(
    leaves: DataFrame,
    keys: Sequence[str],
    cube_cols: Sequence[str],
    measures: Sequence[Measure],
    averages: Sequence[WeightedAverage] = (),
    grouping_col: str | None = None,
) -> DataFrame:
    """The grouping sets over rows of ``cube_leaves``; leaves placed by some of the keys are not shuffled.

    ``grouping_col`` receives the grouping id: bit i is set when the i-th cube
    column (from the right) is a subtotal.
    """
    parts = [*measures, *[a.as_measure() for a in averages]]
    gid = grouping_col or "__grouping_id"
    types = {f.name: f.dataType for f in leaves.schema.fields}
    sets = []
    for bits in range(2 ** len(cube_cols)):
        members = []
        for position, name in enumerate(reversed(cube_cols)):
            rolled_up = bits >> position & 1
            value = F.lit(None).cast(types[name]) if rolled_up else F.col(name)
            members.append(value.alias(name))
        sets.append(F.struct(*reversed(members), F.lit(bits).alias(gid)))
    expanded = leaves.select(*keys, *[m.name for m in parts], F.inline(F.array(*sets)))

    cubed = expanded.groupBy(*keys, *cube_cols, gid).agg(*[m.merge(m.name).alias(m.name) for m in parts])
    return cubed.select(
        *keys,
        *cube_cols,
        *([gid] if grouping_col else []),
        *[m.name for m in measures],
        *[a.final().alias(a.name) for a in averages],
    )


def cube_count_distinct(
    df: DataFrame,
    keys: Sequence[str],
    cube_cols: Sequence[str],
    number: str,
    name: str,
    rows: str = "rows_seen",
) -> DataFrame:
    """``count(DISTINCT number)`` and the row count under ``GROUP BY keys, CUBE(cube_cols)``.

    For whole numbers that lie densely in their groups: a leaf keeps one bitmap
    of 4 KB for 32,768 neighbouring numbers, a grouping set ORs the bitmaps of
    its leaves, and a set's count is the sum over its bitmaps. So what crosses
    the network is bits, a hot group is spread over its ranges of numbers, and no
    row is multiplied by the sets. Where a group has few numbers in each such
    range, distinct rows are the smaller state. NULL is not counted.
    """
    value = F.col(number).cast("bigint")
    held = df.select(
        *keys,
        *cube_cols,
        F.bitmap_bucket_number(value).alias("__range"),
        F.bitmap_bit_position(value).alias("__place"),
    )
    bits = Measure("__bits", F.bitmap_construct_agg("__place"), F.bitmap_or_agg)
    sets = cube_agg(held, [*keys, "__range"], cube_cols, [bits, count_rows(rows)], grouping_col="__set")
    counted = sets.select(*keys, *cube_cols, "__set", F.bitmap_count("__bits").alias("__n"), rows)
    return (
        counted.groupBy(*keys, *cube_cols, "__set")
        .agg(F.sum("__n").alias(name), F.sum(rows).alias(rows))
        .drop("__set")
    )
