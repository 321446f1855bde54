"""Spelling variants: words one edit apart, by composition of finite-state machines.

Let A be the minimal acceptor of the vocabulary and E the transducer that
makes exactly one edit (one code point inserted, deleted or replaced). The
pairs that the composition of A, E and A accepts are the near pairs. A pair
has one accepting path if the edit stands where the words first differ, and
the composed machine has then two kinds of states: before the edit both sides
are in the same state of A, after it in two states that move alike. Where the
two meet in one state, all that A accepts from there follows on both sides.

A is never built whole. Near words share a half: those of ``m`` and of ``m``
or ``m + 1`` code points have either the first ``m // 2`` in common, or the
last ``m - m // 2`` while the edit stands before. So a word goes to four
partitions, each named by such a half and having one initial state; a pair is
accepted in exactly one, as the edit's place decides. Partitions above
``CROWD`` words are halved again in the same way, the range of edit places
with them, down to one place, where few words are possible. Tasks take many
partitions at a time: one acceptor with an initial state for each.

Words are counted per task batch first, near words are counted and the best
one chosen per task; Spark adds up and chooses again. Pairs are never rows.

Defined results: null text has no words; a null doc_id reads as an empty one
in the hash of a planted edit; repeated rows count each; of near words with
equal counts the first in code-point order is the best; an empty table, or one
without frequent words, gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import LOWER_ASCII, claim, materialize, nothing, regroup, texts_of

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_POINTS = 6
LEAST_COUNT = 5
RATIO = 5
TYPO_EVERY = 199
BATCH_BYTES = 4 << 20
LONG_TEXT = 1 << 20
HELD_WORDS = 200_000
# 26 letters and 64 of U+00C0 to U+00FF; two free places and one give 90 * 90 + 90 words.
CROWD = 20_000
BATCH_WORDS = 20_000
SEEDS = 1 << 20


def _runs(text: bytes) -> Counter:
    """Occurrences of each lower-cased run."""
    lower = text.translate(LOWER_ASCII).decode()
    if len(lower) <= LONG_TEXT:
        return Counter(RUN.findall(lower))
    return Counter(m[0] for m in RUN.finditer(lower))


def _count(typo_every: int | None, least_points: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("spelling", nothing)
        held: Counter = Counter()

        def emptied() -> pa.RecordBatch:
            long = {word: n for word, n in held.items() if len(word) >= least_points}
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(long), pa.string()), pa.array(list(long.values()), pa.int64())], ["word", "n"]
            )

        for batch in regroup(batches, "text", BATCH_BYTES):
            ids = batch.column("doc_id").cast(pa.int64()).to_pylist()
            for doc, text in zip(ids, texts_of(batch.column("text")), strict=True):
                runs = _runs(text)
                if typo_every:
                    start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for run in list(runs):
                        h = zlib.crc32(run.encode(), start)
                        if not h % typo_every:
                            at = h % len(run)
                            n = runs.pop(run)
                            held[run[:at] + run[at + 1 :]] += n
                held.update(runs)
                if len(held) > HELD_WORDS:
                    yield emptied()
        yield emptied()

    return count


def count_words(
    docs: DataFrame,
    typo_every: int | None = None,
    least_points: int = LEAST_POINTS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """word, n: lower-cased runs of letters, of at least so many code points and occurrences.

    ``typo_every`` plants a missing code point in about one of so many runs of a document, as the contract of the query
    says.
    """
    counted = docs.select("doc_id", "text").mapInArrow(_count(typo_every, least_points), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


@dataclass
class Acceptor:
    """Minimal acceptor of sorted byte strings, an initial state per partition.

    ``node`` arrays describe the prefix tree it was folded from: state, depth, first row (rows of a node are together),
    first child and number of children. ``begin`` to ``begin + moves`` are a state's moves in ``byte``, ``target`` and
    ``skip``, the rows accepted by smaller moves.
    """

    node_state: np.ndarray
    node_depth: np.ndarray
    node_row: np.ndarray
    node_group: np.ndarray
    node_child: np.ndarray
    node_children: np.ndarray
    node_final: np.ndarray
    node_byte: np.ndarray
    begin: np.ndarray
    moves: np.ndarray
    final: np.ndarray
    accepted: np.ndarray
    byte: np.ndarray
    target: np.ndarray
    skip: np.ndarray
    key: np.ndarray


def _tree(groups: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, ...]:
    """Prefix tree of rows that are sorted by group and word, level by level."""
    lengths = np.array([len(w) for w in words])
    flat = np.frombuffer(b"".join(words), np.uint8)
    places = np.cumsum(lengths) - lengths
    heads = np.flatnonzero(np.diff(groups, prepend=-1))
    parents, bytes_, rows = [np.full(len(heads), -1)], [np.zeros(len(heads), np.uint8)], [heads]
    depths, final = [np.zeros(len(heads), np.int64)], [np.zeros(len(heads), bool)]
    at = np.cumsum(np.diff(groups, prepend=-1) != 0) - 1
    active, total, depth = np.arange(len(words)), len(heads), 0
    while True:
        active = active[lengths[active] > depth]
        if not len(active):
            break
        own = flat[places[active] + depth]
        parent = at[active]
        fresh = np.ones(len(active), bool)
        fresh[1:] = (parent[1:] != parent[:-1]) | (own[1:] != own[:-1])
        at[active] = node = total + np.cumsum(fresh) - 1
        first = np.flatnonzero(fresh)
        parents.append(parent[first])
        bytes_.append(own[first])
        rows.append(active[first])
        ends = np.zeros(len(first), bool)
        ends[node[lengths[active] == depth + 1] - total] = True
        final.append(ends)
        depth += 1
        depths.append(np.full(len(first), depth))
        total += len(first)
    return tuple(map(np.concatenate, (parents, bytes_, rows, depths, final)))


def _pair_up(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number for each distinct pair."""
    return np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)[1]


def minimal_acceptor(groups: np.ndarray, words: list[bytes]) -> Acceptor:
    """Fold states with equal futures, those of the lowest height first."""
    parent, byte, row, depth, final = _tree(groups, words)
    size, roots = len(parent), int((parent < 0).sum())
    children = np.bincount(parent[roots:], minlength=size)
    child = np.full(size, size)
    inner = np.flatnonzero(np.diff(parent[roots:], prepend=-1)) + roots
    child[parent[inner]] = inner
    height = np.zeros(size, np.int64)
    bounds = np.searchsorted(depth, np.arange(depth[-1] + 2))
    for d in range(int(depth[-1]), 0, -1):
        level = slice(bounds[d], bounds[d + 1])
        np.maximum.at(height, parent[level], height[level] + 1)
    state = np.zeros(size, np.int64)
    order = np.argsort(height, kind="stable")
    steps = np.searchsorted(height[order], np.arange(height.max() + 2))
    total, keepers = 0, []
    for h in range(len(steps) - 1):
        nodes = order[steps[h] : steps[h + 1]]
        sign = final[nodes].astype(np.int64)
        for k in range(int(children[nodes].max(initial=0))):
            has = np.flatnonzero(children[nodes] > k)
            own = child[nodes[has]] + k
            move = np.unique(state[own] << 8 | byte[own], return_inverse=True)[1]
            sign[has] = _pair_up(sign[has], move)
        _, keeper, folded = np.unique(sign << 8 | children[nodes], return_index=True, return_inverse=True)
        state[nodes] = total + folded
        keepers.append(nodes[keeper])
        total += len(keeper)
    keeper = np.concatenate(keepers)
    moves = children[keeper]
    begin = np.cumsum(moves) - moves
    inside = np.arange(int(moves.sum())) - np.repeat(begin, moves)
    edge = np.repeat(child[keeper], moves) + inside
    # Rows of a child come after those of its elder siblings.
    skip = row[edge] - np.repeat(row[keeper], moves)
    group = np.zeros(size, np.int64)
    group[:roots] = np.arange(roots)
    for d in range(1, int(depth[-1]) + 1):
        level = slice(bounds[d], bounds[d + 1])
        group[level] = group[parent[level]]
    last = np.append(np.flatnonzero(np.diff(groups, prepend=-1))[1:], len(words))
    # A node's rows end where those of its next sibling begin, else where its parent's do.
    stop = np.zeros(size, np.int64)
    stop[:roots] = last
    for d in range(1, int(depth[-1]) + 1):
        level = np.arange(bounds[d], bounds[d + 1])
        sibling = np.append(parent[level][1:] == parent[level][:-1], False)
        stop[level] = np.where(sibling, np.append(row[level][1:], 0), stop[parent[level]])
    target = state[edge]
    return Acceptor(
        state, depth, row, group, child, children, final, byte, begin, moves, final[keeper], (stop - row)[keeper],
        byte[edge], target, skip, np.repeat(np.arange(total), moves) << 8 | byte[edge],
    )


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the owner and number within it, for so many entries of each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]


def _follow(a: Acceptor, p: np.ndarray, q: np.ndarray, r: np.ndarray, s: np.ndarray, unlike: np.ndarray | None):
    """Rows of all pairs that two states accept alike; ``unlike`` is a byte that the first move of p must not be."""
    while len(p):
        if unlike is None:
            same = p == q
            if same.any():
                owner, k = _spread(a.accepted[p[same]])
                yield r[same][owner] + k, s[same][owner] + k
                p, q, r, s = p[~same], q[~same], r[~same], s[~same]
        both = a.final[p] & a.final[q]
        if both.any():
            yield r[both], s[both]
        owner, k = _spread(a.moves[p])
        move = a.begin[p][owner] + k
        byte = a.byte[move]
        if unlike is not None:
            free = byte != unlike[owner]
            owner, move, byte = owner[free], move[free], byte[free]
        key = q[owner] << 8 | byte
        other = np.searchsorted(a.key, key)
        other[other == len(a.key)] = 0
        met = a.key[other] == key if len(a.key) else np.zeros(len(key), bool)
        owner, move, other = owner[met], move[met], other[met]
        p, q, r, s = a.target[move], a.target[other], r[owner] + a.skip[move], s[owner] + a.skip[other]
        unlike = None


def near_pairs(a: Acceptor, size: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the near words of ``size`` and ``size`` or one more code points, for edits at places ``low`` to ``high``.

    The three are by partition. In pairs of different lengths the longer is second; no pair comes twice.
    """
    place, group = a.node_depth, a.node_group
    free = np.flatnonzero((place >= low[group]) & (place <= high[group]) & (a.node_children > 0))
    weight = np.cumsum(a.node_children[free] * (a.node_children[free] + 1) // 2)
    cuts = np.searchsorted(weight, np.arange(SEEDS, weight[-1] if len(free) else 0, SEEDS))
    for part in np.split(free, cuts):
        # A replaced code point: two children of a node.
        owner, k = _spread(a.node_children[part])
        left = a.node_child[part][owner] + k
        more, j = _spread(a.node_children[part][owner] - 1 - k)
        one, two = left[more], left[more] + 1 + j
        yield from _follow(a, a.node_state[one], a.node_state[two], a.node_row[one], a.node_row[two], None)
        # An inserted one: the shorter word goes on from the node, with another move than the longer's.
        up = part[owner]
        yield from _follow(
            a, a.node_state[up], a.node_state[left], a.node_row[up], a.node_row[left], a.node_byte[left]
        )


NEAR_DDL = "word string, n_near bigint, best_n bigint, best string"
PART_DDL = "word string, n bigint, size int, low int, high int, front int, back int, half string"


def _best_near(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Near words of one batch of whole partitions, counted and the best chosen."""
    words = [p[0].encode("latin-1") for p in parts]
    keys = [(p[2], p[5], p[6], p[7]) for p in parts]
    change = np.array([True, *(a != b for a, b in zip(keys, keys[1:], strict=False))])
    groups = np.cumsum(change) - 1
    size, low, high = (np.array([p[c] for p, new in zip(parts, change.tolist(), strict=True) if new]) for c in (2, 3, 4))
    lengths, counts = np.array([len(w) for w in words]), np.array([p[1] for p in parts])
    whole = minimal_acceptor(groups, words)
    near = np.zeros(len(words), np.int64)
    best = np.full(len(words), -1)
    for one, two in near_pairs(whole, size, low, high):
        # Both words of a replacement have the shorter length; longer ones meet in another partition.
        fits = lengths[one] == size[groups[one]]
        one, two = one[fits], two[fits]
        for own, other in ((one, two), (two, one)):
            near += np.bincount(own, minlength=len(words))
            order = np.lexsort((other, -counts[other], own))
            own, other = own[order], other[order]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            own, other = own[first], other[first]
            held = best[own]
            better = (held < 0) | (counts[other] > counts[held]) | ((counts[other] == counts[held]) & (other < held))
            best[own[better]] = other[better]
    found = np.flatnonzero(near)
    if len(found):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([parts[i][0] for i in found.tolist()], pa.string()), pa.array(near[found]),
                pa.array(counts[best[found]], pa.int64()), pa.array([parts[i][0] for i in best[found].tolist()], pa.string()),
            ],
            [c.split()[0] for c in NEAR_DDL.split(", ")],
        )


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by partition, then word; a batch ends with a partition."""
    claim("spelling", nothing)
    held: list[tuple] = []
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for row in rows:
            if len(held) >= BATCH_WORDS and (row[2], *row[5:]) != (held[-1][2], *held[-1][5:]):
                yield from _best_near(held)
                held = []
            held.append(row)
    if held:
        yield from _best_near(held)


def _halves(parts: DataFrame) -> DataFrame:
    """Each partition as two: edits from the middle place on, and before it.

    ``low`` and ``high`` are the first and last place of the edit; the code points before ``low`` and the last ``back``
    are shared by all words of the partition.
    """
    middle = F.expr("(low + high + 1) div 2").cast("int")
    after = F.struct(middle.alias("low"), F.col("high").alias("high"), middle.alias("front"), F.col("back").alias("back"))
    before = F.struct(
        F.col("low").alias("low"), (middle - 1).cast("int").alias("high"), F.col("front").alias("front"),
        (F.col("size") - middle).cast("int").alias("back"),
    )
    out = parts.select("word", "n", "size", F.explode(F.array(after, before)).alias("p")).select("word", "n", "size", "p.*")
    half = F.concat(F.substring("word", F.lit(1), F.col("front")), F.lit(" "), F.expr("right(word, back)"))
    return out.select("word", "n", "size", "low", "high", "front", "back", half.alias("half"))


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """word, n_near, best_n, best of the words that have near ones.

    ``words`` is a written table of word, n; words are distinct and of code points below U+0100.
    """
    length = F.char_length("word")
    sizes = F.when(length > 1, F.array(length, length - 1)).otherwise(F.array(length))
    zero = F.lit(0).cast("int")
    whole = words.select(
        "word", "n", F.explode(sizes).alias("size"), zero.alias("low"), zero.alias("front"), zero.alias("back")
    ).withColumn("high", F.col("size"))
    parts = _halves(whole)
    name = ["size", "front", "back", "half"]
    ready = []
    while True:
        crowded = parts.groupBy(*name).count().where((F.col("count") > crowd) & (F.col("count") > 1)).select(*name)
        crowded = materialize(crowded, "crowded")
        if crowded.isEmpty():
            ready.append(parts)
            break
        # One place for the edit leaves few words: such partitions are taken as they are.
        split = F.col("low") < F.col("high")
        ready.append(parts.join(crowded, name, "left_anti").unionByName(parts.join(crowded, name, "left_semi").where(~split)))
        parts = materialize(_halves(parts.join(crowded, name, "left_semi").where(split)), "halves")
    dealt = ready[0]
    for more in ready[1:]:
        dealt = dealt.unionByName(more)
    dealt = dealt.select("word", "n", "size", "low", "high", "front", "back", "half")
    tasks = max(1, -(-4 * words.count() // BATCH_WORDS))
    dealt = dealt.repartition(tasks, *name).sortWithinPartitions(*name, "word")
    found = dealt.mapInArrow(_enumerate, NEAR_DDL)
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.max("best_n").alias("best_n"),
        # The least word of those with the greatest count.
        F.min(F.struct((-F.col("best_n")).alias("turned"), F.col("best").alias("best"))).alias("top"),
    ).select("word", "n_near", "best_n", F.col("top.best").alias("best"))


def spelling_variants(
    docs: DataFrame,
    typo_every: int | None = None,
    least_points: int = LEAST_POINTS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    crowd: int = CROWD,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every frequent word.

    A word's form is its near word of the greatest count, if that is at least ``ratio`` (above 1) times its own.
    """
    words = materialize(count_words(docs, typo_every, least_points, least_count), "words")
    near = near_words(words, crowd)
    formed = F.col("best_n") >= ratio * F.col("n")
    table = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
    )
    table = materialize(table, "forms")
    # Counts grow at least ratio times a step, so chains have at most this many.
    most = table.agg(F.max("form_n").alias("most")).first()["most"] or 1
    steps = max(1, math.ceil(math.log(most, ratio) + 1e-9))
    roots = table.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        # Each round doubles the distance that a root was followed.
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"))
        roots = materialize(roots, "roots")
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
