"""Balanced label propagation: linked documents gather in shards of even row counts.

Labels are shards. Every document starts in a shard dealt by number, so counts
differ by one at most, and each later step only swaps places, so they stay so.
A round counts each link group's rows per shard. About half of the groups ask:
their rows outside the shard that holds most of them want to go there (a group
larger than a shard has as many such shards as it fills). Two opposite requests
are exchanged. The others change places with a row of the shard they want: an
unlinked one, or one of a group that does not ask and loses fewer links by the
swap than the asking row gains. Greatest gains meet least losses, so each round
that moves a row lowers the number of cut links, and rounds go on until
``quiet`` of them in a row find no such swap or no group is in more shards than
it needs. Who asks, and which of equally
good shards is wanted, changes by round; every other round takes any shard that
holds near the most, as the best may be full.

Defined results: null text is empty (size 16, crc32 0); repeated rows are
separate rows; an empty table gives an empty table; null ids are ids like any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.common import blocks_for, materialize, numbered

LARGE_GROUP = 10_000
# By powers of two of links gained or lost.
CLASSES = 32


def _place(spread: Column) -> Column:
    return F.xxhash64(F.lit("block"), spread)


def _classed(level: Column, spread: Column, blocks: int) -> Column:
    """A block within the class ``level``, for ``numbered``."""
    level = F.greatest(F.lit(0), F.least(level, F.lit(CLASSES - 1)))
    return level * blocks + F.pmod(_place(spread), F.lit(blocks))


def _wishes(rows: DataFrame, capacity: int, turn: int) -> DataFrame | None:
    """rid, shard, grp, links, loss of the linked rows; target and gain of those that ask; whether they may give way.

    None where no group is in more shards than it needs.
    """
    linked = rows.where("links > 1")
    held = linked.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("here"), F.first("links").alias("links"))
    held = materialize(held, "held")
    spans = held.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.first("links").alias("links"))
    if spans.where(F.col("n") > F.ceil(F.col("links") / F.lit(capacity))).isEmpty():
        return None
    # A group has at most one row per shard here.
    near = F.desc(F.floor(F.log2("here")) if turn % 2 else F.col("here"))
    best = Window.partitionBy("grp").orderBy(near, F.xxhash64("grp", "shard", F.lit(turn)))
    homes = held.withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= F.ceil(F.col("links") / F.lit(capacity))
    )
    homes = homes.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("rank", "shard", "here"))).alias("homes"))
    asks = F.lit(True) if turn < 2 else F.pmod(F.xxhash64("grp", F.lit("asks"), F.lit(turn)), F.lit(2)) == 0
    cells = held.drop("links").join(homes, "grp").withColumn("asks", asks)
    away = F.col("asks") & ~F.array_contains("homes.shard", F.col("shard"))
    home = F.col("homes")[F.pmod(F.xxhash64("rid", F.lit(turn)), F.size("homes")).cast("int")]
    return linked.join(cells, ["grp", "shard"]).select(
        "rid",
        "shard",
        "grp",
        "links",
        (F.col("here") - 1).alias("loss"),
        F.when(away, home["shard"]).alias("target"),
        F.when(away, home["here"] - F.col("here") + 1).alias("gain"),
        (~F.col("asks")).alias("gives"),
    )


def _swaps(rows: DataFrame, capacity: int, blocks: int, turn: int) -> DataFrame | None:
    """rid and new shard of the rows that change places in this round; None where nothing is left to gather."""
    wishes = _wishes(rows, capacity, turn)
    if wishes is None:
        return None
    wishes = materialize(wishes, "wishes")
    requests = wishes.where("gain > 0").select("rid", "shard", "target", "grp", "links", "gain")
    # Groups move together where the quota allows; a large one is spread.
    spread = F.when(F.col("links") > LARGE_GROUP, F.col("rid")).otherwise(F.col("grp"))
    ranked = materialize(
        numbered(requests, ["shard", "target"], ["grp", "rid"], _place(spread), blocks, "turn"), "turns"
    )
    pairs = ranked.groupBy("shard", "target").agg(F.count(F.lit(1)).alias("n"))
    back = pairs.select(F.col("target").alias("shard"), F.col("shard").alias("target"), F.col("n").alias("opposite"))
    ranked = ranked.join(back, ["shard", "target"], "left")
    exchanged = F.col("turn") < F.coalesce("opposite", F.lit(0))
    direct = ranked.where(exchanged).select("rid", F.col("target").alias("to"))
    waiting = materialize(ranked.where(~exchanged).drop("turn", "opposite"), "waiting")
    # Numbers run through the classes, greatest gains and least losses first.
    incoming = numbered(
        waiting, ["target"], [F.desc("gain"), "grp", "rid"], _classed(31 - F.floor(F.log2("gain")), spread, blocks),
        CLASSES * blocks, "turn",
    )
    free = rows.where("links = 1").select("rid", F.col("shard").alias("target"), F.lit(0).cast("bigint").alias("loss"))
    giving = wishes.where("gives").select("rid", F.col("shard").alias("target"), "loss")
    yielding = free.withColumn("class", F.lit(0).cast("bigint")).union(
        giving.withColumn("class", F.floor(F.log2(F.col("loss") + 1)) + 1)
    )
    yielding = numbered(
        yielding, ["target"], ["loss", "rid"], _classed(F.col("class"), F.col("rid"), blocks), CLASSES * blocks, "turn"
    )
    meet = materialize(
        incoming.join(yielding.select(F.col("rid").alias("other"), "target", "turn", "loss"), ["target", "turn"])
        .where("gain > loss")
        .select("rid", "other", "shard", "target"),
        "meet",
    )
    return direct.union(meet.select("rid", F.col("target").alias("to"))).union(
        meet.select(F.col("other").alias("rid"), F.col("shard").alias("to"))
    )


def balanced_shards(docs: DataFrame, shards: int = 40, quiet: int = 4) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    Documents of equal text are linked. The law is ``rows``: counts of any two
    shards differ by one at most.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("grp"),
    )
    base = materialize(base.withColumn("rid", F.monotonically_increasing_id()), "rows")
    total = base.count()
    blocks = blocks_for(total)
    copies = base.groupBy("grp", "size", "text_crc32").agg(F.count(F.lit(1)).alias("links"))
    # A table of its own, so that a large group's side of the join can be split.
    copies = materialize(copies.where("links > 1"), "groups")
    dealt = numbered(base, [], ["rid"], _place(F.col("rid")), blocks, "number")
    rows = materialize(
        dealt.join(copies, ["grp", "size", "text_crc32"], "left")
        .withColumn("links", F.coalesce("links", F.lit(1).cast("bigint")))
        .withColumn("grp", F.xxhash64("grp", "size", "text_crc32"))
        .withColumn("shard", F.pmod("number", F.lit(shards)).cast("int"))
        .drop("number"),
        "labels",
    )
    per_shard = blocks_for(-(-total // shards))
    turn = still = 0
    while still < quiet and total:
        moves = _swaps(rows, max(1, total // shards), per_shard, turn)
        if moves is None:
            break
        moves = materialize(moves, "moves")
        turn += 1
        if moves.isEmpty():
            still += 1
            continue
        still = 0
        moved = rows.join(moves, "rid", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to")
        rows = materialize(moved, "labels")
    placed = numbered(rows, ["shard"], ["rid"], _place(F.col("rid")), per_shard, "slot")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
