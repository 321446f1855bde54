"""Token ids in binary shards with keyed access.

Documents are range-partitioned by id and sorted; each partition becomes one
shard file in the shared folder:

    magic, ids (little-endian, 2 bytes where the vocabulary allows it, else 4),
    record starts (u64, one more than records), keys in record order (i64),
    hash levels (bits), slot fingerprints (u32), slot first record (u32),
    slot records (u32), JSON footer, footer length (u32), magic

A minimal perfect hash maps each distinct key of the shard to a slot: every
level is a bit array in which the keys that hit a bit alone settle, the others
go to the next level, and the slot is the rank of the bit. A slot holds a
fingerprint, which tells foreign keys, and the place of the key's records.

File names are unique to an attempt; the manifest that Spark commits names the
files that count, so a repeated task harms nothing.

Defined results: null text is empty; null doc_id sorts first and is returned
as null; rows that repeat a doc_id are records of one key, in order of a hash
of their text; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.common import materialize, regroup
from quotelake.llm.encode import encoder
from quotelake.session import shared_folder

MAGIC = b"QLTOKEN1"
NULL_KEY = np.int64(-(2**63))
BITS_PER_KEY = 2
BATCH_BYTES = 8 << 20
READ_IDS = 4 << 20


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Levels of bits over distinct 64-bit keys; ``slots`` gives 0..n-1, -1 for some foreign keys."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.before = np.cumsum([0, *(int(bits.sum()) for bits in levels)])
        self.ranks = [np.cumsum(bits) - bits for bits in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = max(8, len(left) * BITS_PER_KEY)
            at = (_mix(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone.astype(np.int64))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = (_mix(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at] == 1
            out[open_[hit]] = self.ranks[level][at[hit]] + self.before[level]
            open_ = open_[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 977) >> np.uint64(32)).astype(np.uint32)


def _write_shards(tokenizer: str, end: int, folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, added=True)
        width = np.dtype("<u2" if max(enc.vocab, end + 1) <= 65536 else "<u4")
        store, base = fs.FileSystem.from_uri(folder)
        shard = TaskContext.get().partitionId()
        path = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex}.ids"
        out, sizes, keys, nulls = None, [], [], 0
        for batch in regroup(batches, "text", BATCH_BYTES):
            if out is None:
                out = store.open_output_stream(path)
                out.write(MAGIC)
            ids, bounds = enc.encode([t or "" for t in batch.column("text").to_pylist()], end)
            out.write(ids.astype(width).tobytes())
            sizes.append(np.diff(bounds))
            doc = batch.column("doc_id").cast(pa.int64())
            nulls += doc.null_count
            keys.append(doc.fill_null(int(NULL_KEY)).to_numpy(zero_copy_only=False))
        if out is None:
            return
        keys, starts = np.concatenate(keys), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        distinct, first, records = np.unique(keys, return_index=True, return_counts=True)
        hashed = PerfectHash.build(distinct)
        slot = hashed.slots(distinct)
        columns = []
        for values in (fingerprints(distinct), first, records):
            column = np.zeros(len(distinct), "<u4")
            column[slot] = values
            columns.append(column)
        for section in (starts.astype("<u8"), keys.astype("<i8"), *map(np.packbits, hashed.levels), *columns):
            out.write(section.tobytes())
        footer = json.dumps(
            {
                "width": width.itemsize, "docs": len(keys), "ids": int(starts[-1]), "keys": len(distinct),
                "nulls": nulls, "levels": [len(bits) for bits in hashed.levels],
            }
        ).encode()
        out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
        out.close()
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "path": path, "docs": len(keys), "ids": int(starts[-1])}]
        )

    return write


def write_token_shards(docs: DataFrame, tokenizer: str, end: int, folder: str) -> DataFrame:
    """Write the shard files; the manifest: shard, path, docs, ids, start (ids of all shards before)."""
    parts = max(1, docs.select("doc_id").rdd.getNumPartitions())
    rows = docs.select("doc_id", "text").withColumn("mark", F.xxhash64("text"))
    rows = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "mark")
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "mark").select("doc_id", "text")
    manifest = rows.mapInArrow(_write_shards(tokenizer, end, folder), "shard bigint, path string, docs bigint, ids bigint")
    manifest = materialize(manifest, "manifest")
    # One row per shard file.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


class TokenShard:
    """An open shard: its index in memory, ids read on demand."""

    def __init__(self, folder: str, path: str) -> None:
        store, _ = fs.FileSystem.from_uri(folder)
        self.file = store.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"not a token shard: {path}")
        length = struct.unpack("<I", tail[:4])[0]
        self.meta = meta = json.loads(self.file.read_at(length, size - 12 - length))
        self.width = np.dtype(f"<u{meta['width']}")
        at = len(MAGIC) + meta["ids"] * meta["width"]
        body = memoryview(self.file.read_at(size - 12 - length - at, at))
        used = 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal used
            values = np.frombuffer(body, kind, n, used)
            used += values.nbytes
            return values

        self.starts = take("<u8", meta["docs"] + 1).astype(np.int64)
        self.keys = take("<i8", meta["docs"])
        levels = [np.unpackbits(take("u1", -(-n // 8)), count=n).astype(np.int64) for n in meta["levels"]]
        self.hash = PerfectHash(levels)
        self.prints, self.first, self.records = (take("<u4", meta["keys"]) for _ in range(3))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; -1 and 0 for keys that are not here."""
        slots = self.hash.slots(keys)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == fingerprints(keys[known])
        at = np.where(known, slots, 0)
        return np.where(known, self.first[at].astype(np.int64), -1), np.where(known, self.records[at].astype(np.int64), 0)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of the records first..last-1, one after the other."""
        a, b = int(self.starts[first]), int(self.starts[last])
        raw = self.file.read_at((b - a) * self.width.itemsize, len(MAGIC) + a * self.width.itemsize)
        return np.frombuffer(raw, self.width).astype("<u4")


def located(shard: TokenShard) -> tuple[np.ndarray, np.ndarray]:
    """Every key of the shard with each of its records, as the perfect hash finds them, in file order."""
    keys = np.unique(shard.keys)
    first, records = shard.find(keys)
    if (first < 0).any() or records.sum() != len(shard.keys) or (shard.keys[first] != keys).any():
        raise ValueError("the index of a token shard does not lead to its keys")
    order = np.argsort(first)
    keys, first, records = keys[order], first[order], records[order]
    return np.repeat(keys, records), np.repeat(first, records) + _within(records)


def _read_shards(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            shard = TokenShard(folder, row["path"])
            owner, record = located(shard)
            done = 0
            while done < len(record):
                # Records that follow one another are read together.
                apart = np.flatnonzero(np.diff(record[done:]) != 1)
                run = done + (int(apart[0]) + 1 if len(apart) else len(record) - done)
                limit = np.searchsorted(shard.starts, shard.starts[record[done]] + READ_IDS, "right") - 1
                last = min(run, max(done + 1, done + int(limit - record[done])))
                begin, end = int(record[done]), int(record[last - 1]) + 1
                raw = memoryview(shard.ids(begin, end).tobytes())
                starts = shard.starts[begin : end + 1]
                offsets = ((starts - starts[0]) * 4).tolist()
                crcs = [zlib.crc32(raw[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)]
                doc = owner[done:last]
                null = record[done:last] < shard.meta["nulls"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc, pa.int64(), mask=null),
                        pa.array(starts[:-1] + row["start"]),
                        pa.array(np.diff(starts)),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                done = last

    return read


def _within(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def token_digest(docs: DataFrame, tokenizer: str, end: int = 2, folder: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, read back from the files by keyed access."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{os.path.abspath(folder)}"
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base)
    manifest = write_token_shards(docs, tokenizer, end, folder)
    shards = max(1, manifest.count())
    return manifest.repartition(shards).mapInArrow(
        _read_shards(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
