"""Benchmark decontamination with a generalised suffix automaton of the items.

The automaton accepts every run of words of every benchmark item. A document's
words are streamed through it; the state after each word gives the longest
run, ending there, that some item contains. A run of ``window`` words is a
hit, and so is a whole item of fewer words; the items that contain a hit are
stored at the automaton's states.

Items of up to ``4 * BLOCK_WORDS`` bytes go to the tasks, where a worker
process builds their automaton once. Larger benchmarks are cut into pieces that
overlap by a window, and dealt to blocks of about that size; every block's
automaton is built once, in a task of its own, and put into the shared folder.
A task then takes ``HELD_BYTES`` of texts at a time through one block after the
other, with one automaton in memory. Neither has a limit on the benchmark; the
time grows with documents times blocks.

Defined results: null text has no words; an item without words matches
nothing; items of null id mark words but are not listed or counted; items that
repeat an id count once; repeated documents are judged each; with an empty
benchmark nothing is hit; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import LOWER_ASCII, claim, materialize, regroup, texts_of
from quotelake.session import shared_folder

WINDOW = 13
BLOCK_WORDS = 200_000
BATCH_BYTES = 4 << 20
HELD_BYTES = 128 << 20

# Words are runs of digits, letters after lower-casing and bytes from 0x80; the rest separates.
WORD_BYTES = bytes(
    LOWER_ASCII[b] if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)

SCHEMA = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, clean string"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Automaton:
    """Suffix automaton over the words of several items."""

    def __init__(self, items: Sequence[tuple[str | None, list[bytes]]], window: int) -> None:
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        states = len(self.next)
        #: Length of the shortest hit that ends in a state's runs; none by default.
        none = 1 << 60
        self.hit = [none] * states
        self.whole: list[set[str | None] | None] = [None] * states
        self.items: list[set[str | None]] = [set() for _ in range(states)]
        seen = [-1] * states
        for at, (name, words) in enumerate(items):
            state = 0
            for word in words:
                state = self.next[state][word]
                up = state
                while up > 0 and seen[up] != at:
                    seen[up] = at
                    self.items[up].add(name)
                    up = self.link[up]
            if 0 < len(words) < window:
                if self.whole[state] is None:
                    self.whole[state] = set()
                self.whole[state].add(name)
                self.hit[state] = len(words)
        for state in sorted(range(1, states), key=self.length.__getitem__):
            inherited = self.hit[self.link[state]] if self.link[state] >= 0 else none
            long = window if self.length[state] >= window else none
            self.hit[state] = min(self.hit[state], inherited, long)

    def _new(self, edges: dict[bytes, int], link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, target: int, word: bytes) -> int:
        """The state of exactly the runs one word longer than ``state``'s."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._new(dict(self.next[target]), self.link[target], self.length[state] + 1)
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._split(last, known, word)
        new = self._new({}, 0, self.length[last] + 1)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, self.next[state][word], word)
        return new

    def scan(self, words: Sequence[bytes], marks: bytearray, found: set[str | None]) -> None:
        """Mark the words inside hits and add the items hit."""
        edges, link, length, hit, window = self.next, self.link, self.length, self.hit, self.window
        root = edges[0]
        state = run = 0
        for at, word in enumerate(words):
            to = edges[state].get(word)
            if to is not None:
                run += 1
            elif state == 0:
                continue
            elif word not in root:
                state = run = 0
                continue
            else:
                while to is None:
                    state = link[state]
                    to = edges[state].get(word)
                run = length[state] + 1
            state = to
            if run >= hit[state]:
                up = state
                while up > 0:
                    held = min(run, length[up])
                    if held >= window:
                        marks[at - window + 1 : at + 1] = b"\x01" * window
                        if length[link[up]] < window:
                            found |= self.items[up]
                    if self.whole[up]:
                        # A whole short item; as a proper suffix it is shorter than the run.
                        size = length[up]
                        if size <= run:
                            marks[at - size + 1 : at + 1] = b"\x01" * size
                            found |= self.whole[up]
                    up = link[up]


def _pieces(window: int, size: int):
    """Items cut into pieces of so many windows, none of them shorter than a window; short items are whole."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column("item").to_pylist(), texts_of(batch.column("text")), strict=True):
                words = words_of(text)
                starts = range(0, max(1, len(words) - window + 1), size) if words else ()
                pieces = [b" ".join(words[at : at + size + window - 1]) for at in starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(pieces), pa.string()), pa.array(pieces, pa.binary())], ["item", "words"]
                )

    return cut


def _store(folder: str, window: int):
    """The automaton of one block to a file of its own; a repeated task writes another one."""

    def store(block: pa.Table) -> pa.Table:
        claim("decontamination", _built.clear)
        rows = zip(block.column("item").to_pylist(), block.column("words").to_pylist(), strict=True)
        items = sorted(((name, words.split()) for name, words in rows), key=lambda r: (r[0] or "", r[1]))
        files, base = fs.FileSystem.from_uri(folder)
        path = f"{base}/block-{uuid.uuid4().hex}"
        with files.open_output_stream(path) as out:
            out.write(pickle.dumps(Automaton(items, window), pickle.HIGHEST_PROTOCOL))
        return pa.table({"path": [path]})

    return store


@dataclass
class StoredBlocks:
    """Automata in the shared folder."""

    folder: str
    paths: list[str]

    def __iter__(self) -> Iterator[Automaton]:
        claim("decontamination", _built.clear)
        _built.clear()
        files, _ = fs.FileSystem.from_uri(self.folder)
        for path in self.paths:
            with files.open_input_file(path) as file:
                automaton = pickle.loads(file.read())
            yield automaton
            # One at a time: this one goes before the next is read.
            del automaton


def remove_marked(text: bytes, marks: bytearray) -> bytes:
    """The text without its marked words; what separates the others stays."""
    plain = text.translate(WORD_BYTES)
    out, at, seen = [], 0, 0
    size = len(plain)
    while at < size:
        begin = at
        while at < size and plain[at] == 0x20:
            at += 1
        out.append(text[begin:at])
        begin = at
        while at < size and plain[at] != 0x20:
            at += 1
        if at > begin:
            if not marks[seen]:
                out.append(text[begin:at])
            seen += 1
    return b"".join(out)


_built: dict[bytes, Automaton] = {}


Items = Sequence[tuple[str | None, bytes]]


def _automata(items: Items | StoredBlocks, window: int) -> Iterator[Automaton]:
    if isinstance(items, StoredBlocks):
        yield from items
    elif items:
        # Kept by the worker process for its next task.
        claim("decontamination", _built.clear)
        digest = hashlib.sha256(repr((window, items)).encode()).digest()
        if digest not in _built:
            _built.clear()
            _built[digest] = Automaton([(n, words_of(t)) for n, t in items], window)
        yield _built[digest]


def _together(batches: Iterator[pa.RecordBatch], items: Items | StoredBlocks) -> Iterator[pa.RecordBatch]:
    """Batches of the size that one reading of the items is for."""
    if not isinstance(items, StoredBlocks):
        yield from regroup(batches, "text", BATCH_BYTES)
        return
    held: list[pa.RecordBatch] = []
    for batch in regroup(batches, "text", BATCH_BYTES):
        held.append(batch)
        if sum(b.nbytes for b in held) >= HELD_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _hits(
    texts: Sequence[bytes], items: Items | StoredBlocks, window: int
) -> tuple[list[bytearray], list[set[str | None]]]:
    """By text: a mark for every word, and the items hit. The words of one text are held at a time."""
    marks = [bytearray() for _ in texts]
    found: list[set[str | None]] = [set() for _ in texts]
    first = True
    for automaton in _automata(items, window):
        for i, text in enumerate(texts):
            words = words_of(text)
            if first:
                marks[i] = bytearray(len(words))
            automaton.scan(words, marks[i], found[i])
        first = False
    if first:
        marks = [bytearray(len(words_of(t))) for t in texts]
    return marks, found


def _contaminated(marks: bytearray, hit_share: int) -> bool:
    hits = marks.count(1)
    return hits > 0 and hit_share * hits >= len(marks)


def _judge(shared, window: int, hit_share: int, cleaned: bool):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches, shared.value):
            texts = texts_of(batch.column("text"))
            marks, found = _hits(texts, shared.value, window)
            names = [sorted(n for n in f if n is not None) for f in found]
            clean = [None] * len(texts)
            if cleaned:
                clean = [remove_marked(t, m).decode() for t, m in zip(texts, marks, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(map(len, marks), pa.int64()),
                    pa.array([m.count(1) for m in marks], pa.int64()),
                    pa.array(map(len, names), pa.int64()),
                    pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in names], pa.string()),
                    pa.array([_contaminated(m, hit_share) for m in marks], pa.bool_()),
                    pa.array(clean, pa.string()),
                ],
                [c.split()[0] for c in SCHEMA.split(", ")],
            )

    return judge


def _items(benchmark: DataFrame, window: int):
    """The benchmark as a broadcast: its texts where they are few, else the places of the blocks' automata."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where(F.octet_length("text") > 0)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= 4 * BLOCK_WORDS:
        held = sorted(((r[0], r[1].encode()) for r in items.collect()), key=lambda r: (r[0] or "", r[1]))
        return spark.sparkContext.broadcast(held)
    folder = shared_folder(spark, "automata")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{os.path.abspath(folder)}"
    files, base = fs.FileSystem.from_uri(folder)
    files.create_dir(base)
    blocks = -(-size // (4 * BLOCK_WORDS))
    pieces = items.mapInArrow(_pieces(window, max(1, BLOCK_WORDS // 4)), "item string, words binary").distinct()
    block = F.pmod(F.xxhash64("item", "words"), F.lit(blocks)).alias("block")
    built = pieces.select("item", "words", block).groupBy("block").applyInArrow(_store(folder, window), "path string")
    # One path per block.
    paths = sorted(r["path"] for r in materialize(built, "blocks").collect())
    return spark.sparkContext.broadcast(StoredBlocks(folder, paths))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, hit_share: int = 20, cleaned: bool = False
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row.

    A document is contaminated when it has hits and they are at least one in
    ``hit_share`` of its words. With ``cleaned`` a column ``clean`` holds the
    text without the words inside hits.
    """
    out = docs.select("doc_id", "text").mapInArrow(_judge(_items(benchmark, window), window, hit_share, cleaned), SCHEMA)
    return out if cleaned else out.drop("clean")


def keep_uncontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, hit_share: int = 20
) -> DataFrame:
    """The rows, all columns, that are not contaminated."""
    shared = _items(benchmark, window)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches, shared.value):
            marks, _ = _hits(texts_of(batch.column("text")), shared.value, window)
            yield batch.filter(pa.array([not _contaminated(m, hit_share) for m in marks], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
