"""Rows to columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_pivot(
    df: DataFrame,
    keys: Sequence[str],
    spec: Mapping[str, tuple[Callable[[Column], Column], Column, Column | str]],
) -> DataFrame:
    """One aggregate per output column over the rows that satisfy its predicate.

    ``spec`` maps an output name to (aggregate, predicate, value). A single
    hash aggregation serves all of them.
    """
    outputs = []
    for name, (aggregate, predicate, value) in spec.items():
        value = F.col(value) if isinstance(value, str) else value
        outputs.append(aggregate(F.when(predicate, value)).alias(name))
    return df.groupBy(*keys).agg(*outputs)


def attribute_pivot(df: DataFrame, key: str, attribute: str, value: str, names: Sequence[str]) -> DataFrame:
    """Attribute-value rows to one row per key.

    Columns are matched by attribute name, so a key that lacks one gets NULL
    there and nothing shifts. The names are given, which spares the extra pass
    that would discover them. Of several values of an attribute the greatest
    stays. A key's pairs are collected (a hash aggregate; a maximum of text would
    sort all rows), which is bounded by its attributes, then sorted once and
    turned into a map that every column looks itself up in.
    """
    known = F.when(F.col(attribute).isin(list(names)), F.struct(attribute, value)).alias("__pair")
    held = df.select(key, known)
    pairs = held.groupBy(key).agg(F.sort_array(F.collect_set("__pair")).alias("__pairs"))

    def greatest(pair: Column, place: Column) -> Column:
        following = F.get("__pairs", place + 1)[attribute]
        return following.isNull() | (following != pair[attribute])

    lookup = F.map_from_entries(F.filter("__pairs", greatest)).alias("__values")
    return pairs.select(key, lookup).select(key, *[F.try_element_at("__values", F.lit(n)).alias(n) for n in names])
