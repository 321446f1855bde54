"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases, the phrases' names into phrases of
phrases, and so on up to one name for the text. On each level equal neighbours
are drawn together into runs; then every symbol gets a small label by coin
tossing: of the lowest bit in which it differs from its left neighbour, the
bit's place and value. Three more rounds on the labels leave values below 6
that still differ between neighbours, and a phrase starts where a label is
greater than both its neighbours. Where a phrase starts hangs on four symbols
to the left and one to the right, never on the place in the text, so equal
substrings have equal phrases but for a few at their ends, on every level. A
name is a 64-bit hash of the phrase's symbols and run lengths.

A fingerprint holds the name of the whole text and, of two levels, the ``KEPT``
least names. The upper one is the highest of ``LEVELS`` levels on which the
text has ``ENOUGH`` phrases (phrases grow about threefold a level, to some 27
bytes on level 3), the other is the one below. Likeness of two fingerprints: 1
where the whole names agree, else the estimated Jaccard similarity of the
phrase names on the highest level that both have, 0 where there is none.

The query compares each document with the next one, in descending order of
doc_id. Texts move once: they are dealt to blocks of that order, whose first
keys come from a bounded sample, and each block also gets the first row of the
next. A block is read in order, one batch and one row more at a time.

Defined results: null text is empty; empty texts are alike, and unlike all
others; a null doc_id comes last in the order; rows that repeat a doc_id follow
one another by a hash of their text, then by the text; of one row alone the
next is itself; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import claim, nothing, regroup, texts_of
from quotelake.llm.ngram_join import mix

LEVELS = 3
ENOUGH = 24
KEPT = 48
NAME_BITS = 40
DIGITS = NAME_BITS // 4
PIECE = 1 << 20
BATCH_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20
MAX_BLOCKS = 1 << 16
SAMPLED = 8
U64 = np.uint64


def _toss(bits: int) -> np.ndarray:
    """Label of a symbol of so many bits, by left neighbour and symbol."""
    left, own = np.meshgrid(np.arange(1 << bits), np.arange(1 << bits), indexing="ij")
    differ = left ^ own
    lowest = differ & -differ
    place = np.zeros_like(lowest)
    for k in range(bits):
        place[lowest == 1 << k] = k
    return (2 * place + ((own >> place) & 1)).astype(np.uint8)


# Labels of bytes are below 16, of 64-bit names below 128; then below 14, 8 and 6.
TOSS_BYTE, TOSS_7, TOSS_4, TOSS_3 = _toss(8), _toss(7), _toss(4), _toss(3)


def _toss_names(left: np.ndarray, own: np.ndarray) -> np.ndarray:
    differ = left ^ own
    lowest = differ & (~differ + U64(1))
    place = ((lowest.astype(np.float64).view(np.int64) >> 52) - 1023).astype(U64)
    return (U64(2) * place + ((own >> place) & U64(1))).astype(np.uint8)


def _left(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Left neighbours; those of the first symbols of texts are made up, unlike the symbol."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[heads] = values[heads] ^ values.dtype.type(1)
    return out


def _labels(symbols: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Labels below 6; neighbours in a text differ. ``heads`` has the first symbol of each text."""
    out = np.empty(len(symbols), np.uint8)
    for at in range(0, len(symbols), PIECE):
        # Four symbols to the left decide; what the cut makes up does not reach the piece.
        low = max(0, at - 4)
        part = symbols[low : at + PIECE]
        own = heads[np.searchsorted(heads, low) : np.searchsorted(heads, at + PIECE)] - low
        if low or not len(own):
            own = np.union1d(own, [0])
        if part.dtype == np.uint8:
            labels = TOSS_BYTE[_left(part, own), part]
        else:
            labels = _toss_names(_left(part, own), part)
            labels = TOSS_7[_left(labels, own), labels]
        labels = TOSS_4[_left(labels, own), labels]
        labels = TOSS_3[_left(labels, own), labels]
        out[at : at + PIECE] = labels[at - low :]
    return out


WEIGHTS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, 65)], U64)


def _names(symbols: np.ndarray, runs: np.ndarray, starts: np.ndarray, level: int) -> np.ndarray:
    """Names of the phrases that start at ``starts``."""
    out = np.empty(len(starts), U64)
    ends = np.append(starts[1:], len(symbols))
    step = PIECE // 4
    with np.errstate(over="ignore"):
        for at in range(0, len(starts), step):
            begin = starts[at : at + step]
            low, high = int(begin[0]), int(ends[min(at + step, len(starts)) - 1])
            sizes = np.diff(np.append(begin, high))
            within = np.arange(high - low) - np.repeat(begin - low, sizes)
            words = symbols[low:high].astype(U64) + runs[low:high].astype(U64) * U64(0xD1B54A32D192ED03)
            words = mix(words) * WEIGHTS[within & 63]
            out[at : at + step] = np.add.reduceat(words, begin - low)
        return mix(out + U64(level + 1) * U64(0x8CB92BA72F3D8DD7))


def _phrases(symbols: np.ndarray, heads: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the next level and the first name of each text; every text has a symbol at least."""
    begins = np.empty(len(symbols), bool)
    begins[0] = True
    np.not_equal(symbols[1:], symbols[:-1], out=begins[1:])
    begins[heads] = True
    at = np.flatnonzero(begins)
    runs = np.diff(np.append(at, len(symbols)))
    heads = np.searchsorted(at, heads)
    symbols = symbols[at]
    labels = _labels(symbols, heads)
    starts = np.zeros(len(symbols), bool)
    starts[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # The last symbol of a text starts nothing: it has no right neighbour.
    starts[heads[1:] - 1] = False
    starts[heads] = True
    firsts = np.flatnonzero(starts)
    return _names(symbols, runs, firsts, level), np.searchsorted(firsts, heads)


def parse(texts: Sequence[bytes]) -> tuple[list[list[np.ndarray]], np.ndarray]:
    """Of texts that are not empty: the names on each of ``LEVELS`` levels, and the name of the whole text."""
    sizes = np.array([len(t) for t in texts])
    symbols, heads = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes
    levels: list[list[np.ndarray]] = [[] for _ in texts]
    whole = np.zeros(len(texts), U64)
    open_ = np.arange(len(texts))
    level = 0
    while len(open_):
        symbols, heads = _phrases(symbols, heads, level)
        ends = np.append(heads[1:], len(symbols))
        if level < LEVELS:
            for i, a, b in zip(open_.tolist(), heads.tolist(), ends.tolist(), strict=True):
                levels[i].append(symbols[a:b])
        level += 1
        done = ends - heads == 1
        with np.errstate(over="ignore"):
            whole[open_[done]] = mix(symbols[heads[done]] + U64(level))
        if done.any():
            keep = np.repeat(~done, ends - heads)
            left = (ends - heads)[~done]
            symbols, heads, open_ = symbols[keep], np.cumsum(left) - left, open_[~done]
    return levels, whole


def fingerprints(texts: Sequence[bytes]) -> list[str]:
    """``whole name.level.names of the level.names of the level below``, in hexadecimal; '' for empty texts."""
    full = [i for i, t in enumerate(texts) if t]
    out = [""] * len(texts)
    if full:
        levels, whole = parse([texts[i] for i in full])
        for i, names, name in zip(full, levels, whole.tolist(), strict=True):
            level = max((k for k, found in enumerate(names) if len(found) >= ENOUGH), default=0)
            parts = [np.unique(names[k] >> U64(64 - NAME_BITS))[:KEPT] for k in (level, level - 1) if k >= 0]
            listed = [p.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS // 2 :].tobytes().hex() for p in parts]
            out[i] = ".".join([f"{name:016x}", str(level + 1), *listed])
    return out


def _read(fingerprint: str) -> tuple[str, dict[int, list[str]]]:
    name, level, *listed = fingerprint.split(".")
    names = {int(level) - k: [t[i : i + DIGITS] for i in range(0, len(t), DIGITS)] for k, t in enumerate(listed)}
    return name, names


def likeness(one: str, other: str) -> float:
    """1 for the same text, else the estimated share of common phrases, 0 to 1."""
    if one == other:
        return 1.0
    if not one or not other:
        return 0.0
    (_, own), (_, theirs) = _read(one), _read(other)
    shared = own.keys() & theirs.keys()
    if not shared:
        return 0.0
    level = max(shared)
    a, b = set(own[level]), set(theirs[level])
    # Digits of one length sort as numbers do. A list that is not full has all names of its text.
    least = sorted(a | b)[:KEPT]
    return sum(name in a and name in b for name in least) / len(least)


FINGERPRINT_DDL = "doc_id bigint, fingerprint string"


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim("fingerprints", nothing)
    for batch in regroup(batches, "text", BATCH_BYTES):
        prints = fingerprints(texts_of(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(prints, pa.string())], ["doc_id", "fingerprint"]
        )


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row, without a shuffle."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprint, FINGERPRINT_DDL)


ROUTED_DDL = "block int, extra boolean, last boolean, turned bigint, mark bigint, doc_id bigint, text string"
EDITED_DDL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _route(bounds: list[tuple]):
    """Block of each row; the first row of a block is also the last one's follower in the block before."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("last", "turned", "mark")), strict=True))
            own = [bisect_right(bounds, k) - 1 for k in keys]
            firsts = [i for i, (k, b) in enumerate(zip(keys, own, strict=True)) if k == bounds[b]]
            for rows, blocks, extra in (
                (batch, own, False),
                (batch.take(pa.array(firsts, pa.int64())), [(own[i] - 1) % len(bounds) for i in firsts], True),
            ):
                if rows.num_rows:
                    marks = [pa.array(blocks, pa.int32()), pa.array([extra] * rows.num_rows)]
                    yield pa.RecordBatch.from_arrays(
                        [*marks, *rows.columns], ["block", "extra", *rows.schema.names]
                    )

    return route


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block, in order, the followers of a block last."""
    claim("fingerprints", nothing)
    names = [c.split()[0] for c in EDITED_DDL.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    waiting: list[tuple[int, bool, int, str]] = []
    for batch in regroup(batches, "text", BATCH_BYTES):
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("block", "extra", "doc_id", "text")), strict=True))
        rows = waiting + rows
        waiting = rows[-1:]
        pairs = [(r, s) for r, s in zip(rows, rows[1:], strict=False) if not r[1] and r[0] == s[0]]
        if not pairs:
            continue
        edited = [r[3][: len(r[3]) - len(r[3]) // 3] + s[3][: len(r[3]) // 3] for r, s in pairs]
        edited = [t.encode() for t in edited]
        texts = [t for pair in pairs for t in (pair[0][3], pair[1][3])]
        distinct = list(dict.fromkeys(texts))
        known = dict(zip(distinct, fingerprints([t.encode() for t in distinct]), strict=True))
        prints = fingerprints(edited)
        out = [
            (
                r[2], len(r[3]), hashlib.sha256(text).hexdigest(), known[r[3]], new,
                likeness(known[r[3]], new), likeness(known[r[3]], known[s[3]]),
            )
            for (r, s), text, new in zip(pairs, edited, prints, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(v), t) for v, t in zip(zip(*out, strict=True), types, strict=True)], names
        )


def compare_with_next(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text has its last third replaced by the beginning of the next document in descending order of doc_id;
    after the last comes the first.
    """
    rows = docs.select(
        F.col("doc_id").isNull().alias("last"),
        # Ascending where doc_id descends.
        F.coalesce(F.bitwise_not(F.col("doc_id").cast("bigint")), F.lit(0)).alias("turned"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    key = F.struct("last", "turned", "mark")
    whole = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min(key).alias("first")
    ).first()
    if not whole["n"]:
        return docs.sparkSession.createDataFrame([], EDITED_DDL)
    blocks = max(1, min(MAX_BLOCKS, whole["bytes"] // block_bytes))
    bounds = [tuple(whole["first"])]
    if blocks > 1:
        share = min(1.0, SAMPLED * blocks / whole["n"])
        draw = F.shiftrightunsigned(F.xxhash64("turned", "mark", F.lit("block")), 11) / F.lit(float(1 << 53))
        drawn = sorted({tuple(r) for r in rows.where(draw < share).select("last", "turned", "mark").collect()})
        bounds = sorted({bounds[0], *drawn[SAMPLED // 2 :: max(1, len(drawn) // blocks)]})
    routed = rows.mapInArrow(_route(bounds), ROUTED_DDL)
    routed = routed.repartition(len(bounds), "block")
    order = ["block", "extra", "last", "turned", "mark", "text"]
    return routed.sortWithinPartitions(*order).mapInArrow(_compare, EDITED_DDL)
