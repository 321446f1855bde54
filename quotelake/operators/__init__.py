"""Generic DataFrame operators the data products are built from."""

from quotelake.operators.calendar import date_dimension, date_windows, day_series, days_spanned
from quotelake.operators.conform import add_literal, conform, stack_frames
from quotelake.operators.cube import (
    WeightedAverage,
    count_rows,
    cube_agg,
    cube_count_distinct,
    cube_leaves,
    cube_of_leaves,
    highest,
    lowest,
    total,
)
from quotelake.operators.golden import first_record
from quotelake.operators.joins import attach, full_outer_merge, keep_matching
from quotelake.operators.pivot import attribute_pivot, conditional_pivot
from quotelake.operators.ranges import range_blocks, ranged_neighbours
from quotelake.operators.ranks import dense_rank_of_distinct, peer_percentile
from quotelake.operators.stats import (
    attach_group_stats,
    latest_flag,
    latest_snapshot,
    share_of_partition,
    value_neighbours,
    zscore,
)

__all__ = [
    "WeightedAverage",
    "add_literal",
    "attach",
    "attach_group_stats",
    "attribute_pivot",
    "conditional_pivot",
    "conform",
    "count_rows",
    "cube_agg",
    "cube_count_distinct",
    "cube_leaves",
    "cube_of_leaves",
    "date_dimension",
    "date_windows",
    "day_series",
    "days_spanned",
    "dense_rank_of_distinct",
    "first_record",
    "full_outer_merge",
    "highest",
    "keep_matching",
    "latest_flag",
    "latest_snapshot",
    "lowest",
    "peer_percentile",
    "range_blocks",
    "ranged_neighbours",
    "share_of_partition",
    "stack_frames",
    "total",
    "value_neighbours",
    "zscore",
]
