"""Byte-level BPE ids of whole texts, with the work of repeated words saved.

A cut before a space that follows a non-space never lies inside a token, so a
text is encoded piece by piece: a space-separated word has the same ids
wherever it stands. Arrow splits the texts of a batch and numbers their
distinct words. Words that a task process has met are looked up; the new ones
of a batch go to the tokenizers library together. The ids are those of one
call per text.
"""

from __future__ import annotations

import functools
import os
import re
from array import array
from collections.abc import Sequence
from itertools import repeat

# A task has one core; read by the library at its first call.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
import regex  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from quotelake.llm.common import claim  # noqa: E402

# Spaces of any kind (and the controls that some call spaces), then what is up to the next.
UNITS = regex.compile(r"[\s\x1c-\x1f]*[^\s\x1c-\x1f]+|[\s\x1c-\x1f]+")
FIRST = regex.compile(r"[ \n]|$")
# Where a text of words, each after one space or line feed, may not be cut before every word.
SPACES = re.compile(r"\s\s")
# New words that are encoded as one text.
TOGETHER = 500
# About 110 bytes a unit. With 200,000 a worker encodes so many words anew that it takes a tenth more time, or more.
MAX_UNITS = 320_000
MAX_IDS = 2_560_000


class _Marks(dict):
    def __init__(self, owner: CachedEncoder) -> None:
        self.owner = owner

    def __missing__(self, mark: str) -> int:
        row = self[mark] = self.owner._add(mark)
        return row


class CachedEncoder:
    def __init__(self, path: str, added: bool = False) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.vocab = self.tokenizer.get_vocab_size()
        tokens = [t for t in self.tokenizer.get_added_tokens_decoder().values() if added or not t.special]
        # Those that take in spaces around them or need a word's bounds are left to the library.
        self.apart = not any(t.lstrip or t.rstrip or t.single_word or t.content[-1:].isspace() for t in tokens)
        longest = sorted((t.content for t in tokens), key=len, reverse=True)
        self.added = regex.compile(f"({'|'.join(map(regex.escape, longest))})") if longest else None
        # A byte-level token has a character for each of its bytes.
        self.token_bytes = np.zeros(max(self.vocab, 1 + max(self.tokenizer.get_vocab().values(), default=0)), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.token_bytes[i] = len(token)
        self._reset()

    def _reset(self) -> None:
        # Word as split (one that begins a line has its line feed) -> row of the id table.
        self.words: dict[str, int] = {}
        self.marks = _Marks(self)
        # Units to encode at the batch's end; in these stretches of them, words without the space before them.
        self.new: list[str] = []
        self.bare: list[tuple[int, int]] = []
        self.ids = array("I")
        self.starts = array("q")
        self.sizes = array("q")
        self.uses = np.zeros(0, np.int64)

    def _shrink(self) -> None:
        """Forget the units that were used least."""
        least = 2
        while (self.uses >= least).sum() > MAX_UNITS // 2 or np.array(self.sizes)[self.uses >= least].sum() > MAX_IDS // 2:
            least *= 2
        keep = self.uses >= least
        row = np.cumsum(keep) - 1
        words, marks = ({u: int(row[r]) for u, r in table.items() if keep[r]} for table in (self.words, self.marks))
        sizes = np.array(self.sizes, np.int64)[keep]
        ends = np.cumsum(sizes)
        at = np.repeat(np.array(self.starts, np.int64)[keep] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        ids, uses = np.array(self.ids, np.uint32)[at], self.uses[keep] // 2
        self._reset()
        self.words.update(words)
        self.marks.update(marks)
        self.ids.frombytes(ids.tobytes())
        self.starts.frombytes((ends - sizes).tobytes())
        self.sizes.frombytes(sizes.tobytes())
        self.uses = uses

    def _add(self, unit: str) -> int:
        """Row that the unit's ids will have after the batch."""
        self.new.append(unit)
        return len(self.starts) + len(self.new) - 1

    def _marked(self, text: str) -> list[int]:
        """Rows of a text with added tokens."""
        if not self.apart:
            return [self._add(text)]
        rows: list[int] = []
        for k, part in enumerate(self.added.split(text)):
            if k % 2:
                rows.append(self.marks[part])
            elif part:
                rows.extend(self._units([part])[0].tolist())
        return rows

    def _word_rows(self, words: list[str]) -> np.ndarray:
        """Rows of distinct words; -1 where the next cut is not safe."""
        rows = np.fromiter(map(self.words.get, words, repeat(-2)), np.int64, len(words))
        at = np.flatnonzero(rows == -2)
        fresh = [words[i] for i in at.tolist()]
        unsafe = [i for i, w in enumerate(fresh) if not w or w[-1].isspace()]
        if unsafe:
            rows[at[unsafe]] = -1
            at = np.flatnonzero(rows == -2)
            fresh = [words[i] for i in at.tolist()]
        first = len(self.starts) + len(self.new)
        rows[at] = np.arange(first, first + len(fresh))
        self.words.update(zip(fresh, range(first, first + len(fresh)), strict=True))
        self.bare.append((len(self.new), len(self.new) + len(fresh)))
        self.new.extend(fresh)
        return rows

    def _units(self, texts: Sequence[str], column: pa.Array | None = None) -> list[np.ndarray]:
        """Rows of the units of texts that are not empty and have no added tokens.

        Units start before a space or line feed that follows a non-space.
        """
        if not texts:
            return []
        column = pa.array(texts, pa.large_string()) if column is None else column.cast(pa.large_string())
        lines = pc.replace_substring(column, "\n", " \n")
        split = pc.split_pattern(lines, " ")
        coded = split.flatten().dictionary_encode()
        rows = self._word_rows(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        bounds = split.offsets.to_numpy()
        heads = bounds[:-1]
        # No space comes before the first word of a text.
        for at, text in zip(heads.tolist(), texts, strict=True):
            word = text[: FIRST.search(text).start()]
            rows[at] = self._add(word) if word and not word[-1].isspace() else -1
        unsafe = np.minimum.reduceat(rows, heads) < 0
        found = [rows[a:b] for a, b in zip(heads.tolist(), bounds[1:].tolist(), strict=True)]
        for i in np.flatnonzero(unsafe).tolist():
            # Some space follows a space: cut only where it is safe.
            found[i] = np.array([self._add(u) for u in UNITS.findall(texts[i])], np.int64)
        return found

    def _rows(self, texts: Sequence[str], column: pa.Array | None) -> list[np.ndarray]:
        """Rows of each text."""
        none = np.zeros(0, np.int64)
        out = [none] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.added is not None and self.added.search(text):
                out[i] = np.array(self._marked(text), np.int64)
            else:
                plain.append(i)
        column = None if column is None else column.take(pa.array(plain, pa.int64()))
        for i, rows in zip(plain, self._units([texts[i] for i in plain], column), strict=True):
            out[i] = rows
        return out

    def _encode_new(self) -> None:
        """Ids of the batch's new units. Words go to the library as one text; a cut before a word is never in a token, so
        the bytes of the tokens tell where each word's ids are."""
        units, self.new = self.new, []
        bare, self.bare = self.bare, []
        starts, sizes = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        chunks, texts = [], []
        for first, stop in bare:
            for at in range(first, stop, TOGETHER):
                chunk = np.arange(at, min(at + TOGETHER, stop))
                words = units[at : at + len(chunk)]
                units[at : at + len(chunk)] = own = [w if w[0] == "\n" else " " + w for w in words]
                text = "".join(own)
                if SPACES.search(text):
                    # Words that begin with a space of another kind go alone.
                    chunk = chunk[[not u[1].isspace() for u in own]]
                    text = "".join([units[i] for i in chunk.tolist()])
                if len(chunk):
                    chunks.append(chunk)
                    texts.append(text)
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        alone = np.ones(len(units), bool)
        for chunk, text, coded in zip(chunks, texts, found, strict=True):
            ids = np.array(coded.ids, np.uint32)
            ends = np.cumsum(self.token_bytes[ids])
            raw = np.frombuffer(text.encode(), np.uint8)
            # A word holds no space and no line feed but the one before it.
            wanted = np.append(np.flatnonzero((raw == 0x20) | (raw == 0x0A))[1:], len(raw))
            last = np.searchsorted(ends, wanted)
            if last[-1] == len(ends) - 1 and (ends[last] == wanted).all():
                first = np.concatenate([[0], last[:-1] + 1])
                starts[chunk], sizes[chunk], alone[chunk] = first + len(self.ids), last + 1 - first, False
                self.ids.frombytes(ids.tobytes())
        left = np.flatnonzero(alone).tolist()
        for i, text in zip(left, self.tokenizer.encode_batch_fast([units[i] for i in left], add_special_tokens=False), strict=True):
            starts[i], sizes[i] = len(self.ids), len(text.ids)
            self.ids.extend(text.ids)
        self.starts.frombytes(starts.tobytes())
        self.sizes.frombytes(sizes.tobytes())

    def encode(
        self, texts: Sequence[str], end: int, column: pa.Array | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, ``end`` after each text, and the bounds of the texts (one more than texts).

        ``column`` holds the same texts in Arrow where they came from there; its nulls are empty texts.
        """
        if len(self.starts) > MAX_UNITS or len(self.ids) > MAX_IDS:
            self._shrink()
        last = len(self.starts)
        self.starts.append(len(self.ids))
        self.ids.append(end)
        self.sizes.append(1)
        found = self._rows(texts, column)
        stop = np.array([last], np.int64)
        counts = [len(rows) + 1 for rows in found]
        self._encode_new()
        at = np.concatenate([stop[:0], *(part for rows in found for part in (rows, stop))])
        uses = np.bincount(at, minlength=len(self.starts))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        # Views: the tables are larger than a batch. None outlives the call, as a table cannot grow under one.
        sizes = np.frombuffer(self.sizes, np.int64)[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.frombuffer(self.starts, np.int64)[at] - (ends - sizes)
        flat = np.frombuffer(self.ids, np.uint32)[np.repeat(shift, sizes) + np.arange(total)]
        bounds = np.zeros(len(texts) + 1, np.int64)
        bounds[1:] = ends[np.cumsum(counts) - 1] if counts else 0
        return flat, bounds


@functools.lru_cache(maxsize=2)
def encoder(path: str, added: bool = False) -> CachedEncoder:
    """One encoder per tokenizer, reading of added tokens and worker process."""
    claim("encode", encoder.cache_clear)
    return CachedEncoder(path, added)
