"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q, at least
``max(LEAST, TIMES * q)`` words long, that no neighbouring word extends.

The suffix automaton of a stretch has a tree of suffix links, of which each
root path is the suffixes of a prefix. Paths are kept in a link-cut tree whose
preferred paths hold one value each: the place at which their strings last
ended. Appending a word accesses the path of its prefix; every segment met
there gives the last end of its longest string, and the segment takes the new
end. Where new and last end are no further apart than that string is long,
words with that distance as period stand there: two copies at least. A string
``TIMES - 1`` distances long makes ``TIMES`` copies; its start and distance
name the run, and the last word that still reports it is the run's end. By the
periodicity lemma such a distance is the smallest period and the start cannot
be moved left.

Only stretches where every four-word window stands again nearby are searched:
a run of q has each of its windows again q words off, and q is at most the
stretch's length over ``TIMES``. Stretches are narrowed until that holds, and
no run lies outside them.

Documents are worked on by themselves, without a shuffle. Memory is bounded by
``BATCH_BYTES`` of text, or one text where that is longer, and about a
kilobyte per word of the longest stretch searched.

Defined results: null text has no words; repeated rows are searched each; with
``planted`` a null doc_id is not rewritten; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quotelake.llm.common import claim, nothing, regroup, texts_of
from quotelake.llm.ngram_join import mix

LEAST = 6
TIMES = 4
GRAM = 4
BATCH_BYTES = 4 << 20
U64 = np.uint64
FAR = np.int64(1) << np.int64(60)


class SuffixAutomaton:
    """States of a whole stretch: suffix links, longest lengths, and the state of each prefix."""

    def __init__(self, words: Sequence[int]) -> None:
        moves: list[dict[int, int]] = [{}]
        self.links, self.lengths, self.prefixes = [-1], [0], []
        links, lengths = self.links, self.lengths
        last = 0
        for word in words:
            state = len(moves)
            moves.append({})
            links.append(0)
            lengths.append(lengths[last] + 1)
            self.prefixes.append(state)
            at, last = last, state
            while at >= 0 and word not in moves[at]:
                moves[at][word] = state
                at = links[at]
            if at < 0:
                continue
            target = moves[at][word]
            if lengths[target] == lengths[at] + 1:
                links[state] = target
                continue
            copy = len(moves)
            moves.append(dict(moves[target]))
            links.append(links[target])
            lengths.append(lengths[at] + 1)
            links[target] = links[state] = copy
            while at >= 0 and moves[at].get(word) == target:
                moves[at][word] = copy
                at = links[at]


class LastEnds:
    """Link-cut tree over suffix links; each preferred path has one last end, kept at its splay root."""

    def __init__(self, automaton: SuffixAutomaton) -> None:
        size = len(automaton.links)
        self.up = list(automaton.links)
        self.less, self.more = [-1] * size, [-1] * size
        self.ends = [-1] * size
        self.lengths = automaton.lengths

    def _rotate(self, x: int, p: int, top: bool) -> None:
        """``x`` over its parent ``p``, which is the root of its path if ``top``."""
        up, less, more = self.up, self.less, self.more
        g = up[p]
        if less[p] == x:
            inner = less[p] = more[x]
            more[x] = p
        else:
            inner = more[p] = less[x]
            less[x] = p
        if inner >= 0:
            up[inner] = p
        up[p], up[x] = x, g
        if top:
            self.ends[x] = self.ends[p]
        elif less[g] == p:
            less[g] = x
        else:
            more[g] = x

    def _splay(self, x: int) -> None:
        up, less, more = self.up, self.less, self.more
        while True:
            p = up[x]
            if p < 0 or (less[p] != x and more[p] != x):
                return
            g = up[p]
            if g < 0 or (less[g] != p and more[g] != p):
                self._rotate(x, p, True)
                return
            above = up[g]
            top = above < 0 or (less[above] != g and more[above] != g)
            if (less[g] == p) == (less[p] == x):
                self._rotate(p, g, top)
                self._rotate(x, p, top)
            else:
                self._rotate(x, p, False)
                self._rotate(x, g, top)

    def access(self, state: int, end: int) -> Iterator[tuple[int, int]]:
        """Longest string and last end of each segment from ``state`` to the root; all then end at ``end``."""
        below, x = -1, state
        while x >= 0:
            self._splay(x)
            if self.ends[x] >= 0:
                yield self.lengths[x], self.ends[x]
            cut = self.more[x]
            if cut >= 0:
                self.ends[cut] = self.ends[x]
            self.more[x] = below
            self.ends[x] = end
            below, x = x, self.up[x]


def word_runs(words: Sequence[int]) -> list[tuple[int, int, int]]:
    """Start, length and period of every run of a stretch, by start, then period."""
    automaton = SuffixAutomaton(words)
    tree = LastEnds(automaton)
    ends: dict[tuple[int, int], int] = {}
    for end, state in enumerate(automaton.prefixes):
        for length, last in tree.access(state, end):
            period = end - last
            if length >= (TIMES - 1) * period:
                ends[end - period - length + 1, period] = end
    runs = [(start, end - start + 1, period) for (start, period), end in ends.items()]
    return sorted((r for r in runs if r[1] >= LEAST), key=lambda r: (r[0], r[2]))


def stretches(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of the stretches that may hold runs, of texts that follow one another in ``ids``."""
    firsts = np.cumsum(counts) - counts
    left = np.repeat(firsts + counts, counts) - np.arange(len(ids))
    begins = np.flatnonzero(left >= GRAM)
    near = np.full(len(ids), FAR)
    if len(begins):
        with np.errstate(over="ignore"):
            keys = np.repeat(np.arange(len(counts)), counts)[begins].astype(U64)
            for k in range(GRAM):
                keys = mix(keys * U64(0x9E3779B97F4A7C15) + ids[begins + k].astype(U64))
        order = np.argsort(keys, kind="stable")
        same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
        earlier, later = begins[order[same]], begins[order[same + 1]]
        near[later] = later - earlier
        near[earlier] = np.minimum(near[earlier], later - earlier)
    marked = near < FAR
    while True:
        edges = np.diff(np.concatenate([[0], marked.view(np.int8), [0]]))
        begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        size = end - begin + GRAM - 1
        # Windows that stand too far from their like for the stretch are in no run.
        limit = np.repeat(np.where(size < LEAST, 0, size // TIMES), end - begin)
        at = np.flatnonzero(marked)
        fits = near[at] <= limit
        if fits.all():
            return begin, end + GRAM - 1
        marked[at[~fits]] = False


def repeat_from(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's planted repetition: a tenth of the documents, chosen by crc32 of doc_id, repeat a part of theirs."""
    n = len(words)
    if doc_id is None or not n:
        return words
    g, chosen = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if chosen:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def collapse(words: list[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words that are not a later copy in some run, with one space between."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept).tolist())


def runs_of(texts: Sequence[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as words."""
    numbers = _Numbers()
    counts = np.array([len(w) for w in texts], np.int64)
    ids = np.fromiter((numbers[w] for words in texts for w in words), np.int64, int(counts.sum()))
    firsts = np.cumsum(counts) - counts
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    begin, end = stretches(ids, counts)
    owners = np.searchsorted(firsts, begin, "right") - 1
    # Texts without words share their first place with the next; the last of equals owns it.
    for a, b, owner in zip(begin.tolist(), end.tolist(), owners.tolist(), strict=True):
        shift = a - int(firsts[owner])
        found[owner] += [(s + shift, n, p) for s, n, p in word_runs(ids[a:b].tolist())]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


RUNS_DDL = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

DIGEST_DDL = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _search(batches: Iterator[pa.RecordBatch], planted: bool):
    claim("periodic_runs", nothing)
    for batch in regroup(batches, "text", BATCH_BYTES):
        ids = batch.column("doc_id").cast(pa.int64()).to_pylist()
        texts = [t.split() for t in texts_of(batch.column("text"))]
        if planted:
            texts = [repeat_from(words, doc) for words, doc in zip(texts, ids, strict=True)]
        yield ids, texts, runs_of(texts)


def _list_runs(planted: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, found in _search(batches, planted):
            named = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array([len(w) for w in texts], pa.int64()),
                    pa.array(named, pa.list_(RUN)),
                    pa.array([collapse(w, r).decode() for w, r in zip(texts, found, strict=True)], pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return rows


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in DIGEST_DDL.split(", ")]
    types = [pa.int64()] * 6 + [pa.string()] * 2
    for ids, texts, found in _search(batches, True):
        rows = []
        for doc, words, runs in zip(ids, texts, found, strict=True):
            best: tuple = (None,) * 4
            for start, length, period in runs:
                # Runs come by start, then period: an equal exponent does not displace the first.
                if best[0] is None or length * best[2] > best[1] * period:
                    best = (start, length, period, 1000 * length // period)
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            rows.append(
                (
                    doc, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(),
                    hashlib.sha256(collapse(words, runs)).hexdigest(),
                )
            )
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(columns, types, strict=True)], names)


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed text of every row.

    ``planted`` first repeats parts of a tenth of the documents, as the contract of the query says.
    """
    return docs.select("doc_id", "text").mapInArrow(_list_runs(planted), RUNS_DDL)


def run_digests(docs: DataFrame) -> DataFrame:
    """The same with planted repetition, reduced to the greatest run and digests; one row per document."""
    return docs.select("doc_id", "text").mapInArrow(_digest, DIGEST_DDL)
