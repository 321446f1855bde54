"""Order-preserving packing of token streams into windows of at most 1024 ids.

A task takes the documents of its partition in order, as one stream per run of
about a million ids, and cuts it by dynamic programming. Windows may end at a
document's end for nothing, at a sentence's end or inside a sentence for a
truncation penalty in ids; a window shorter than 1024 costs its padding, none
where its length is a power of two. With f the least cost up to a boundary,

    f(j) = penalty(j) + min over windows (i, j] of f(i) + padding(j - i)

and since padding is linear in the length, the minimum of f(i) + i over the
reachable boundaries comes from a queue kept monotone: one step per boundary.
Windows of a power of two, and stretches of two to ``QUEUES`` windows whose
inner cuts lie inside sentences, are few: they are found for all boundaries of
a run beforehand.
What a run leaves at its end is split into powers of two, so runs and
partitions add no padding. Sequences never cross tasks, and nothing is
shuffled. Every end of a document and of a sentence is a boundary; where none
comes for a window's length, every 64th id is a place to cut inside.

Defined results: null text is empty and gives the end id alone; repeated rows
are packed each; an empty table gives an empty table; other columns are
ignored. sequence_id holds the task in its upper bits.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quotelake.llm.common import regroup, trim
from quotelake.llm.encode import encoder

WINDOW = 1024
SENTENCE_CUT = 1
INNER_CUT = 4
SEQUENCE = 1
QUEUES = 4
GAP_STEP = 64
NEVER = 1 << 62
RUN_IDS = 1 << 20
# Pages given back have to be had again, which costs time.
TRIM_RUNS = 4
BATCH_BYTES = 1 << 20

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def padding(length: int, window: int = WINDOW) -> int:
    return 0 if length & (length - 1) == 0 else window - length


@functools.lru_cache(maxsize=2)
def sentence_ends(tokenizer: str) -> np.ndarray:
    """By id: whether a token closes a sentence or line."""
    enc = encoder(tokenizer, added=True)
    ends = np.zeros(enc.vocab + 1, bool)
    for token, at in enc.tokenizer.get_vocab(with_added_tokens=False).items():
        # In byte-level vocabularies the line feed is written as U+010A.
        ends[at] = token[-1:] in (".", "!", "?", "Ċ")
    return ends


def boundaries(ids: np.ndarray, doc_ends: np.ndarray, closes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, from 0 to the run's length, and their penalties."""
    marked = np.concatenate([[True], closes[ids]])
    ends = np.zeros(len(marked), bool)
    ends[doc_ends] = True
    marked |= ends
    marked[-1] = True
    places = np.flatnonzero(marked)
    penalty = np.where(ends[places], 0, SENTENCE_CUT)
    # Where no sentence ends for a window's length, a window may end at every 64th id.
    wide = np.flatnonzero(np.diff(places) > WINDOW)
    if not len(wide):
        return places, penalty
    added = np.concatenate([np.arange(places[i] + GAP_STEP, places[i + 1], GAP_STEP) for i in wide.tolist()])
    order = np.argsort(np.concatenate([places, added]), kind="stable")
    return np.concatenate([places, added])[order], np.concatenate([penalty, np.full(len(added), INNER_CUT)])[order]


def steps(places: np.ndarray, window: int = WINDOW) -> tuple[list[int], list[int], list[int]]:
    """Windows and stretches of windows that cost other than one padded window: from, to and their cost with their length.

    Windows of a power of two, and stretches of two to ``QUEUES`` windows whose inner cuts lie inside sentences. A stretch
    that could be cut at a boundary instead, whose penalty is no higher, is left out: it cannot cost less.
    """
    at = np.arange(len(places))
    sources, targets, costs = [], [], []
    size = window // 2
    while size >= 16:
        found = np.searchsorted(places, places - size)
        hit = np.flatnonzero(places[found] == places - size)
        sources.append(found[hit])
        targets.append(hit)
        costs.append(np.full(len(hit), size + SEQUENCE))
        size //= 2
    back = [np.searchsorted(places, places - q * window) for q in range(1, QUEUES + 1)]
    for q in range(1, QUEUES):
        # A boundary r windows before the end at most, and whole windows after the start, would do.
        least = np.min([places[back[r - 1]] - (q + 1 - r) * window for r in range(1, q + 1)], 0)
        first, counts = back[q], np.maximum(np.searchsorted(places, least) - back[q], 0)
        shift = np.repeat(first - (np.cumsum(counts) - counts), counts)
        sources.append(shift + np.arange(len(shift)))
        targets.append(np.repeat(at, counts))
        costs.append(np.full(len(shift), (q + 1) * (window + SEQUENCE) + q * INNER_CUT))
    order = np.argsort(np.concatenate(targets), kind="stable")
    return tuple(np.concatenate(parts)[order].tolist() for parts in (sources, targets, costs))


def best_cuts(places: np.ndarray, penalties: np.ndarray, window: int = WINDOW) -> list[int]:
    """Ends of the windows of least cost."""
    sources, targets, costs = steps(places, window)
    targets.append(-1)
    pos, pen = places.tolist(), penalties.tolist()
    # The first boundary that a window ending here may start at.
    starts = np.searchsorted(places, places - window).tolist()
    n, whole = len(pos), window + SEQUENCE
    # Cost up to a boundary with its place: padding makes all windows that end there equally long.
    reach, came = [pos[0]] * n, [0] * n
    # Boundaries of the last window, least reach first; those before ``head`` are out of it.
    queue, values = [], []
    head = step = 0
    for j in range(1, n):
        value = reach[j - 1]
        while len(values) > head and values[-1] >= value:
            values.pop()
            queue.pop()
        values.append(value)
        queue.append(j - 1)
        start = starts[j]
        best = NEVER
        if start < j:
            while queue[head] < start:
                head += 1
            best, source = values[head] + whole, queue[head]
        while targets[step] == j:
            value = reach[sources[step]] + costs[step]
            if value < best:
                best, source = value, sources[step]
            step += 1
        if best == NEVER:
            source = j - 1
            length = pos[j] - pos[source]
            cuts = (length - 1) // window
            best = reach[source] + length + cuts * (INNER_CUT + SEQUENCE) + padding(length - cuts * window, window) + SEQUENCE
        reach[j], came[j] = best + pen[j], source
    # The end of the run takes powers of two instead of padding.
    last, total = n - 1, pos[-1]
    for i in range(n - 2, -1, -1):
        length = total - pos[i]
        if length > window:
            break
        pieces = length.bit_count()
        value = reach[i] + length + (pieces - 1) * INNER_CUT + pieces * SEQUENCE
        if value <= reach[last]:
            reach[last], came[last] = value, i
    cuts, j = [], last
    while j > 0:
        i = came[j]
        inside = []
        at = pos[i]
        while pos[j] - at > window:
            at += window
            inside.append(at)
        rest = pos[j] - at
        if j == last:
            for bit in reversed(range(rest.bit_length())):
                if rest >> bit & 1:
                    at += 1 << bit
                    inside.append(at)
        else:
            inside.append(pos[j])
        cuts.extend(reversed(inside))
        j = i
    return cuts[::-1]


def _pack(docs: list[int | None], ids: np.ndarray, bounds: np.ndarray, closes: np.ndarray, first: int):
    """Pieces of one run; also the number of sequences."""
    places, penalties = boundaries(ids, bounds[1:], closes)
    ends = np.array(best_cuts(places, penalties), np.int64)
    seq_starts = np.concatenate([[0], ends[:-1]])
    cut = np.zeros(len(ids) + 1, bool)
    cut[0] = cut[ends] = cut[bounds] = True
    cuts = np.flatnonzero(cut)
    a, b = cuts[:-1], cuts[1:]
    doc = np.searchsorted(bounds, a, "right") - 1
    seq = np.searchsorted(seq_starts, a, "right") - 1
    raw = memoryview(ids.astype("<u4").tobytes())
    crcs = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    arrays = [
        pa.array(docs, pa.int64()).take(pa.array(doc)),
        pa.array(a - bounds[doc]),
        pa.array(b - a),
        pa.array(crcs, pa.int64()),
        pa.array(np.diff(bounds)[doc]),
        pa.array(seq + first),
        pa.array(a - seq_starts[seq]),
    ]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in SCHEMA.split(", ")]), len(ends)


def _runs(tokenizer: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, closes = encoder(tokenizer, added=True), sentence_ends(tokenizer)
        sequence = TaskContext.get().partitionId() << 36
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        runs = 0

        def flush():
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            return _pack(docs, np.concatenate(held), bounds, closes, sequence)

        for batch in regroup(batches, "text", BATCH_BYTES):
            column = batch.column("text")
            ids, bounds = enc.encode([t or "" for t in column.to_pylist()], end, column)
            docs.extend(batch.column("doc_id").to_pylist())
            held.append(ids)
            sizes.append(np.diff(bounds))
            if sum(map(len, held)) >= RUN_IDS:
                out, used = flush()
                yield out
                sequence += used
                docs, held, sizes = [], [], []
                runs += 1
                if runs % TRIM_RUNS == 0:
                    trim()
        if docs:
            yield flush()[0]

    return run


def pack_documents(docs: DataFrame, tokenizer: str, end: int = 0) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return docs.select("doc_id", "text").mapInArrow(_runs(tokenizer, end), SCHEMA)
