"""Pick one record per key out of many sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_record(
    df: DataFrame,
    key: str,
    ascending: Sequence[str],
    descending: str,
    highest_as: str,
) -> DataFrame:
    """The record that ranks first by ``ascending`` then ``descending``, NULLs last.

    Same result as ``RANK() = 1`` followed by DISTINCT: records that tie on all
    ranking columns are equal, so one per key remains. Equal records collapse
    before they are shuffled (hashed, with map-side combining), so the window
    sees a key's distinct records only, also where the key has a third of all
    rows. ``highest_as`` receives the key's greatest ``descending`` value over
    all records.
    """
    distinct = df.select(key, *ascending, descending).distinct()
    whole = Window.partitionBy(key)
    order = [*[F.col(c).asc_nulls_last() for c in ascending], F.col(descending).desc_nulls_last()]
    ranked = distinct.select(
        "*",
        F.max(descending).over(whole).alias(highest_as),
        F.row_number().over(whole.orderBy(*order)).alias("__place"),
    )
    return ranked.where(F.col("__place") == 1).select(key, *ascending, descending, highest_as)
