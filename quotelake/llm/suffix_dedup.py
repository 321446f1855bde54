"""Removal of long byte strings that occur elsewhere, by two-stage suffix sorting.

A string of ``length`` bytes is removed wherever it starts if it also starts
anywhere else. Suffixes must meet to be sorted together, so places are grouped
by content first: every window of ``length`` bytes has an anchor, the byte run
of ``GRAM`` bytes in it whose hash is least (the first one of equals). Equal
windows have equal anchors, and consecutive windows mostly share one, so a
document splits into segments of windows, each under its anchor's hash. Only
hashes that occur at two places are looked at further; segments are
pre-aggregated by content before they are moved.

Segments of like anchors meet in a task, which sorts their suffixes in two
stages: suffixes smaller than their successor are sorted directly, the others
are induced from them by scans of the first-byte buckets in order. Suffixes
that agree on ``length`` bytes are then neighbours, and a comparison of
neighbours finds them. An anchor with one content needs no sorting. An anchor
of very many contents (a line or passage that thousands of documents have) is
not put in one task: its contents are cut into blocks of ``STEPS`` windows at
fixed distances from the anchor, and blocks are grouped by what all windows of
a block have in common. Different surroundings then part; what still is too
much is cut finer, down to single windows, of which equal ones are one row.

Defined results: null text is empty; texts shorter than ``length`` keep all
bytes; repeated rows are occurrences of each other; matches never cross
documents; strings are judged on the input; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import materialize, regroup, texts_of
from quotelake.llm.ngram_join import mix

GRAM = 32
BLOCK = 1 << 19
BATCH_BYTES = 8 << 20
SORT_BYTES = 256 << 10
BUCKET_BYTES = 1 << 20
MANY = 200
STEPS = (64, 8, 1)
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, U64), np.full(n - 1, base, U64)]))


_up, _down = _powers(BASE, BLOCK + 4096), _powers(INVERSE, BLOCK + 4096)


def run_hashes(text: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at each place; ``text`` is at most a block long."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, U64), np.cumsum((text.astype(U64) + U64(1)) * _up[: len(text)])])
        return mix((sums[size:] - sums[:-size]) * _down[: len(text) - size + 1])


def segments(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window, end of windows and anchor place of each segment, in order."""
    hashes, firsts, ends, places = [], [], [], []
    windows = len(text) - length + 1
    view = np.frombuffer(text, np.uint8)
    span = length - GRAM + 1
    for at in range(0, max(windows, 0), BLOCK):
        part = view[at : at + BLOCK + length - 1]
        grams = run_hashes(part, GRAM)
        # The place in the low bits makes the first of equal hashes the least.
        least = (grams & U64(~0xFFFFF & (2**64 - 1))) | np.arange(len(grams), dtype=U64)
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        anchor = (least & U64(0xFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        hashes.append(grams[anchor[new]].view(np.int64))
        firsts.append(new + at)
        ends.append(np.concatenate([new[1:], [len(anchor)]]) + at)
        places.append(anchor[new] + at)
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([*x, none]) for x in (hashes, firsts, ends, places))


def _anchors(length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", BATCH_BYTES):
            keys, hashes, counts = [], [], []
            for key, text in zip(batch.column("row").to_pylist(), texts_of(batch.column("text")), strict=True):
                found, n = np.unique(segments(text, length)[0], return_counts=True)
                keys.append(np.full(len(found), key, np.int64))
                hashes.append(found)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*x, np.zeros(0, np.int64)])) for x in (keys, hashes, counts)],
                ["row", "anchor", "n"],
            )

    return find


# kind 0: a document without candidates; 1: a document's text; 2: a content; 3: where it stands.
PARTS = pa.schema(
    [
        ("kind", pa.int8()), ("row", pa.int64()), ("doc_id", pa.int64()), ("anchor", pa.int64()),
        ("content", pa.binary()), ("body", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("at", pa.int64()),
    ]
)
PARTS_DDL = (
    "kind tinyint, row bigint, doc_id bigint, anchor bigint, content binary, body binary, first bigint, n bigint, "
    "at bigint"
)


def _split(length: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", BATCH_BYTES):
            rows: list[tuple] = []
            bodies: dict[tuple[int, bytes], list] = {}
            columns = (batch.column(c).to_pylist() for c in ("row", "doc_id", "anchors"))
            for row, doc, wanted, text in zip(*columns, texts_of(batch.column("text")), strict=True):
                if not wanted:
                    rows.append((0, row, doc, None, hashlib.sha256(text).digest(), None, None, len(text), None))
                    continue
                rows.append((1, row, doc, None, None, text, None, len(text), None))
                hashes, firsts, ends, places = segments(text, length)
                for i in np.flatnonzero(np.isin(hashes, np.array(wanted, np.int64))).tolist():
                    anchor, first = int(hashes[i]), int(firsts[i])
                    body = text[first : int(ends[i]) + length - 1]
                    content = xxhash.xxh3_128_digest(body)
                    rows.append((3, row, None, anchor, content, None, first, int(ends[i]) - first, None))
                    # Equal bodies have the anchor at the same place.
                    bodies.setdefault((anchor, content), [body, int(places[i]) - first, 0])[2] += 1
            rows.extend((2, None, None, a, c, body, None, n, at) for (a, c), (body, at, n) in bodies.items())
            columns = zip(*rows, strict=True) if rows else [[]] * len(PARTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(v), f.type) for v, f in zip(columns, PARTS, strict=True)], schema=PARTS
            )

    return split


def suffix_order(text: bytes, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The ``wanted`` places of a text in order of at least ``depth`` bytes of their suffixes.

    ``wanted`` flags places. Places smaller than their successors are sorted
    directly, if they are wanted or a wanted place leads to them; the others
    follow by scanning the buckets of first bytes in ascending order.
    """
    view = np.frombuffer(text, np.uint8)
    n = len(view)
    # Equal bytes take the type of what follows them; the text's end is least.
    rising = np.zeros(n, bool)
    differs = np.flatnonzero(view[:-1] != view[1:])
    if len(differs):
        after = np.searchsorted(differs, np.arange(n))
        known = after < len(differs)
        at = differs[after[known]]
        rising[np.flatnonzero(known)] = view[at] < view[at + 1]
    places = np.flatnonzero(rising)
    # Needed: wanted places, and every place up to the next rising one after them.
    next_rising = np.full(n, n - 1, np.int64)
    if len(places):
        at = np.searchsorted(places, np.arange(n))
        next_rising[at < len(places)] = places[at[at < len(places)]]
    need = np.zeros(n + 1, np.int64)
    flagged = np.flatnonzero(wanted)
    np.add.at(need, flagged, 1)
    np.add.at(need, next_rising[flagged] + 1, -1)
    need = np.cumsum(need[:n]) > 0
    direct = sorted(np.flatnonzero(rising & need).tolist(), key=lambda i: text[i : i + depth])
    direct = np.array(direct, np.int64)
    heads = view[direct]
    bounds = np.searchsorted(heads, np.arange(257))
    falling: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and need[n - 1] and not rising[n - 1]:
        falling[view[n - 1]].append(np.array([n - 1]))
    out = []

    def induce(from_places: np.ndarray, byte: int) -> np.ndarray:
        """Put the falling predecessors in their buckets; those of this bucket come back."""
        before = from_places[from_places > 0] - 1
        before = before[~rising[before] & need[before]]
        first = view[before]
        same = before[first == byte]
        rest = before[first != byte]
        order = np.argsort(view[rest], kind="stable")
        rest = rest[order]
        bytes_, starts = np.unique(view[rest], return_index=True)
        for b, part in zip(bytes_.tolist(), np.split(rest, starts[1:]), strict=False):
            falling[b].append(part)
        return same

    for byte in range(256):
        ready = np.concatenate(falling[byte]) if falling[byte] else np.zeros(0, np.int64)
        while len(ready):
            out.append(ready)
            ready = induce(ready, byte)
        own = direct[bounds[byte] : bounds[byte + 1]]
        if len(own):
            out.append(own)
            induce(own, byte)
    order = np.concatenate([*out, np.zeros(0, np.int64)])
    return order[wanted[order]]


def repeated_places(bodies: Sequence[bytes], length: int) -> list[np.ndarray]:
    """For each body the windows that occur twice among all bodies."""
    text = b"".join(bodies)
    starts = np.concatenate([[0], np.cumsum([len(b) for b in bodies])])
    wanted = np.zeros(len(text), bool)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        wanted[a : b - length + 1] = True
    order = suffix_order(text, wanted, length).tolist()
    hit = np.zeros(len(text), bool)
    previous, last = b"", -1
    for place in order:
        here = text[place : place + length]
        if here == previous:
            hit[place] = hit[last] = True
        previous, last = here, place
    return [np.flatnonzero(hit[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]


def runs_of(places: np.ndarray) -> list[int]:
    """First and end of each run of consecutive places, one after the other."""
    if not len(places):
        return []
    breaks = np.flatnonzero(np.diff(places) != 1)
    firsts = places[np.concatenate([[0], breaks + 1])]
    ends = places[np.concatenate([breaks, [len(places) - 1]])] + 1
    return np.stack([firsts, ends], 1).ravel().tolist()


RUNS_DDL = "anchor bigint, content binary, runs array<bigint>"


def _sorted_bucket(length: int):
    def find(table: pa.Table) -> pa.Table:
        table = table.sort_by("anchor")
        anchors, contents, runs = [], [], []
        names = table.column("anchor").to_pylist()
        bodies, marks, n = (table.column(c).to_pylist() for c in ("body", "content", "n"))

        def close(a: int, b: int) -> None:
            for i, places in zip(range(a, b), repeated_places(bodies[a:b], length), strict=True):
                found = [0, len(bodies[i]) - length + 1] if n[i] > 1 else runs_of(places)
                if found:
                    anchors.append(names[i])
                    contents.append(marks[i])
                    runs.append(found)

        begin = held = 0
        for i, body in enumerate(bodies):
            if held >= SORT_BYTES and names[i] != names[i - 1]:
                close(begin, i)
                begin, held = i, 0
            held += len(body)
        if bodies:
            close(begin, len(bodies))
        return pa.table(
            {
                "anchor": pa.array(anchors, pa.int64()),
                "content": pa.array(contents, pa.binary()),
                "runs": pa.array(runs, pa.list_(pa.int64())),
            }
        )

    return find


def _block(body: bytes, at: int, block: int, step: int, length: int) -> tuple[int, int, bytes]:
    """First and end of the body's windows in a block, and what all windows of the whole block share."""
    begin = at + block * step
    first, end = max(0, begin), min(len(body) - length + 1, begin + step)
    return first, end, body[begin + step - 1 : begin + length]


def _block_keys(length: int, step: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("anchor", "content", "body", "at", "n"))
            for anchor, content, body, at, n in zip(*columns, strict=True):
                windows = len(body) - length + 1
                for block in range(-at // step, (windows - 1 - at) // step + 1):
                    _, _, core = _block(body, at, block, step, length)
                    key = xxhash.xxh3_64_intdigest(core, (anchor * 31 + block) & (2**64 - 1)) - (1 << 63)
                    rows.append((anchor, content, block, key, n))
            yield _batch(rows, [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()], KEYS_DDL)

    return cut


def _pieces(length: int, step: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("anchor", "content", "body", "at", "n", "blocks"))
            for anchor, content, body, at, n, blocks in zip(*columns, strict=True):
                for wanted in blocks:
                    first, end, _ = _block(body, at, wanted["block"], step, length)
                    piece = body[first : end + length - 1]
                    rows.append(
                        (anchor, content, first, wanted["key"], xxhash.xxh3_128_digest(piece), piece, at - first, n)
                    )
            types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            yield _batch(rows, types, PIECES_DDL)

    return cut


def _batch(rows: list[tuple], types: list[pa.DataType], ddl: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    names = [c.split()[0] for c in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(columns, types, strict=True)], names)


KEYS_DDL = "anchor bigint, content binary, block bigint, key bigint, n bigint"
PIECES_DDL = (
    "whole_anchor bigint, whole_content binary, first bigint, anchor bigint, content binary, body binary, "
    "at bigint, n bigint"
)


def _repeated(contents: DataFrame, length: int, steps: Sequence[int]) -> DataFrame:
    """anchor, content, runs: the windows of each content that occur twice under its anchor.

    ``contents`` (anchor, content, body, at, n) is a table with one row per
    anchor and content.
    """
    counts = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents"))
    sized = contents.join(counts, "anchor")
    all_windows = F.array(F.lit(0).cast("bigint"), (F.length("body") - length + 1).cast("bigint")).alias("runs")
    only = sized.where("contents = 1 AND n > 1").select("anchor", "content", all_windows)
    some = sized.where(f"contents BETWEEN 2 AND {MANY}").select("anchor", "content", "body", "n")
    total = contents.agg(F.sum(F.length("body"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-total // BUCKET_BYTES))))
    runs = only.union(some.groupBy(bucket.alias("bucket")).applyInArrow(_sorted_bucket(length), RUNS_DDL))
    if not steps:
        return runs
    hot = materialize(sized.where(f"contents > {MANY}").drop("contents"), "hot")
    if hot.isEmpty():
        return runs
    keys = materialize(hot.mapInArrow(_block_keys(length, steps[0]), KEYS_DDL), "blocks")
    again = keys.groupBy("key").agg(F.sum("n").alias("total")).where("total > 1").select("key")
    wanted = keys.join(again, "key").groupBy("anchor", "content")
    wanted = wanted.agg(F.collect_list(F.struct("block", "key")).alias("blocks"))
    pieces = hot.join(wanted, ["anchor", "content"]).select("anchor", "content", "body", "at", "n", "blocks")
    pieces = materialize(pieces.mapInArrow(_pieces(length, steps[0]), PIECES_DDL), "pieces")
    finer = pieces.groupBy("anchor", "content").agg(
        F.first("body").alias("body"), F.first("at").alias("at"), F.sum("n").alias("n")
    )
    finer = _repeated(materialize(finer, "contents"), length, steps[1:])
    back = pieces.select("whole_anchor", "whole_content", "first", "anchor", "content").join(finer, ["anchor", "content"])
    moved = F.transform("runs", lambda place: place + F.col("first"))
    back = back.groupBy(F.col("whole_anchor").alias("anchor"), F.col("whole_content").alias("content")).agg(
        F.flatten(F.collect_list(moved)).alias("runs")
    )
    return runs.union(back)


RESULT_DDL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _cut(length: int, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "body", "spans"))
            for doc, text, spans in zip(*columns, strict=True):
                pieces, at, removed, count = [], 0, 0, 0
                edge = -1
                for span in sorted((s["first"], s["end"]) for s in spans or ()):
                    first, end = span[0], span[1] + length - 1
                    if first > edge:
                        count += 1
                        pieces.append(text[at:first])
                    else:
                        first = at
                    if end > at:
                        removed += end - max(first, at)
                        at = end
                    edge = max(edge, end)
                pieces.append(text[at:])
                kept = b"".join(pieces)
                rows.append((doc, len(text), removed, count, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(v), t) for v, t in zip(columns, types, strict=True)],
                [c.split()[0] for c in RESULT_DDL.split(", ")],
            )

    return cut


def remove_repeats(docs: DataFrame, length: int = 400, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    ``with_text`` adds ``kept``, the bytes that stay (a cut may part a character).
    """
    # Rows of the same id and text are alike in all that follows.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", F.lit("\x1f"), "text"))
    anchors = materialize(
        rows.select("row", "text").mapInArrow(_anchors(length), "row bigint, anchor bigint, n bigint"), "anchors"
    )
    again = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    wanted = anchors.join(again, "anchor").groupBy("row").agg(F.collect_set("anchor").alias("anchors"))
    parts = rows.join(wanted, "row", "left").select("row", "doc_id", "text", "anchors")
    parts = materialize(parts.mapInArrow(_split(length), PARTS_DDL), "parts")
    contents = parts.where("kind = 2").groupBy("anchor", "content")
    contents = contents.agg(F.first("body").alias("body"), F.first("at").alias("at"), F.sum("n").alias("n"))
    runs = materialize(_repeated(materialize(contents, "contents"), length, STEPS), "runs")
    places = parts.where("kind = 3").select("row", "anchor", "content", "first").join(runs, ["anchor", "content"])
    pair = F.transform(
        F.sequence(F.lit(0), (F.size("runs") / 2).cast("int") - 1),
        lambda i: F.struct(
            (F.col("first") + F.col("runs")[(2 * i).cast("int")]).alias("first"),
            (F.col("first") + F.col("runs")[(2 * i + 1).cast("int")]).alias("end"),
        ),
    )
    spans = places.select("row", F.explode(pair).alias("span")).groupBy("row").agg(F.collect_set("span").alias("spans"))
    texts = parts.where("kind = 1").select("row", "doc_id", "body").join(spans, "row", "left")
    cut = texts.select("doc_id", "body", "spans").mapInArrow(_cut(length, with_text), RESULT_DDL)
    zero = F.lit(0).cast("bigint")
    if with_text:
        # The texts of untouched documents are not among the parts.
        same = rows.join(wanted.select("row"), "row", "left_anti").select(
            "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), zero.alias("n_removed"),
            zero.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.encode("text", "UTF-8").alias("kept"),
        )
        return cut.union(same)
    same = parts.where("kind = 0").select(
        "doc_id", F.col("n").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        F.lower(F.hex("content")).alias("kept_sha256"),
    )
    return cut.drop("kept").union(same)
