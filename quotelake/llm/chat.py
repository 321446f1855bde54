"""Chat logs: collapse cumulative snapshots, render what is maximal.

A log often holds a conversation again and again as it grows. A rolling hash
over the turns gives every prefix of every conversation a key (its length and
a positional sum of turn hashes); a conversation whose full key is a proper
prefix key of another is a snapshot, and an anti-join removes it. Of equal
conversations the smallest id stays, with the number of copies.

Turns are numbered by one range-partitioned sort, and the rolling sums run per
range with the totals of earlier ranges added, so a conversation of any length
is spread over tasks. A rendered conversation is returned in parts of at most
``turns_per_part`` turns.

Defined results: turns sort by turn, role, then the MD5 of the text; null
turn is first; null role and text are empty; rows of null conv_id are one
conversation with id null; repeated rows are turns of their own; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.common import materialize

SUMS = ["h0", "h1", "h2"]


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns with their position from 1 and the rolling hash up to them."""
    spark = conversations.sparkSession
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.md5(text).alias("mark"))
    order = ["conv_id", "turn", "role", "mark"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered = materialize(
        ordered.withColumn("at", F.monotonically_increasing_id()).withColumn("range", F.spark_partition_id()),
        "turns",
    )
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("range") == F.col("__range"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    spans = ordered.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    spans = spans.select(
        F.col("conv_id").alias("__conv"),
        F.col("range").alias("__range"),
        "first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("turns"),
    )
    placed = ordered.join(spans, same).withColumn("pos", F.col("at") - F.col("first") + F.col("before") + 1)
    a = F.xxhash64("pos", "role", F.lit("\x1f"), "text")
    b = F.xxhash64("text", F.lit("\x1f"), "role", "pos")
    low = F.lit(0xFFFFFFFF).cast("bigint")
    hashed = placed.select(
        "conv_id", "range", "pos", "turns", "role", "text",
        F.shiftrightunsigned(a, 32).alias("h0"), a.bitwiseAND(low).alias("h1"), b.bitwiseAND(low).alias("h2"),
    )
    hashed = materialize(hashed, "positions")
    totals = hashed.groupBy("conv_id", "range").agg(*[F.sum(h).alias(h) for h in SUMS])
    totals = totals.select(
        F.col("conv_id").alias("__conv"),
        F.col("range").alias("__range"),
        *[F.coalesce(F.sum(h).over(earlier), F.lit(0)).alias(f"__{h}") for h in SUMS],
    )
    so_far = Window.partitionBy("conv_id", "range").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rolling = hashed.select("conv_id", "range", "pos", "turns", "role", "text", *[F.sum(h).over(so_far).alias(h) for h in SUMS])
    rolling = rolling.join(totals, same)
    return rolling.select(
        "conv_id", "pos", "turns", "role", "text", *[(F.col(h) + F.col(f"__{h}")).alias(h) for h in SUMS]
    )


def collapse_snapshots(turns: DataFrame) -> DataFrame:
    """conv_id, copies of the conversations that prefix no longer one."""
    full = turns.where(F.col("pos") == F.col("turns")).groupBy("pos", *SUMS)
    full = full.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    prefixes = turns.where(F.col("pos") < F.col("turns")).select("pos", *SUMS).distinct()
    return full.join(prefixes, ["pos", *SUMS], "left_anti").select("conv_id", "copies")


def format_chats(conversations: DataFrame, turns_per_part: int = 256) -> DataFrame:
    """conv_id, part, n_turns, copies, rendered: maximal conversations in chat markup."""
    turns = materialize(_turns(conversations), "rolling")
    keep = materialize(collapse_snapshots(turns), "maximal").select(F.col("conv_id").alias("__keep"), "copies")
    kept = turns.join(keep, F.col("conv_id").eqNullSafe(F.col("__keep")))
    line = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n")).alias("line")
    part = F.floor((F.col("pos") - 1) / turns_per_part).alias("part")
    lines = kept.select("conv_id", part, "turns", "copies", F.struct("pos", line).alias("item"))
    grouped = lines.groupBy("conv_id", "part", "turns", "copies").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return grouped.select(
        "conv_id", "part", F.col("turns").alias("n_turns"), "copies", F.array_join("items.line", "").alias("rendered")
    )
