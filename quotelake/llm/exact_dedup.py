"""Exact dedup over a cuckoo-filter index of live digests.

Every text is lower-cased (A-Z only) and digested. A map task first folds the
copies that it holds itself into one entry, so a group of any size reaches its
index as one entry per task. Entries go to index shards by digest; a shard is
a cuckoo filter of short fingerprints over buckets that hold the stored
digests. A lookup that hits the filter is verified against the bucket's
content; when the survivor of a group changes, the old live digest is deleted
and the new one inserted; when an insertion finds no place, the filter is
rebuilt at twice the size from the stored keys.

Defined results: null text counts as empty; a null doc_id is less than any
other and wins only where the group has no other; rows that repeat a doc_id in
a group all carry that keep_id, and each of them is ``kept``; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import LOWER_ASCII, claim, materialize, nothing, texts_of

SLOTS = 4
MAX_KICKS = 200
FOLD_ROWS = 200_000
INDEX_ROWS = 2_000


class CuckooIndex:
    """Fingerprints in a cuckoo filter, stored keys beside their bucket.

    ``keys[b]`` lists (digest, value) of the entries whose fingerprint lies in
    bucket ``b``; the filter alone answers most lookups of absent digests.
    """

    def __init__(self, buckets: int = 64) -> None:
        self.resizes = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints: list[list[int]] = [[] for _ in range(buckets)]
        self.keys: list[list[tuple[bytes, tuple]]] = [[] for _ in range(buckets)]

    def __len__(self) -> int:
        return sum(map(len, self.keys))

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") | 1
        first = int.from_bytes(digest[2:10], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & self.mask)

    def _find(self, digest: bytes) -> tuple[int, int] | None:
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            if mark in self.prints[bucket]:
                for at, (key, _) in enumerate(self.keys[bucket]):
                    if key == digest:
                        return bucket, at
        return None

    def get(self, digest: bytes) -> tuple | None:
        """The live value of a digest; a filter hit is verified on the stored key."""
        found = self._find(digest)
        return self.keys[found[0]][found[1]][1] if found else None

    def delete(self, digest: bytes) -> bool:
        found = self._find(digest)
        if found is None:
            return False
        bucket, at = found
        del self.prints[bucket][at], self.keys[bucket][at]
        return True

    def insert(self, digest: bytes, value: tuple) -> None:
        """Add a digest that is not live."""
        mark, bucket, second = self._places(digest)
        entry = (digest, value)
        if len(self.prints[bucket]) >= SLOTS and len(self.prints[second]) < SLOTS:
            bucket = second
        for kick in range(MAX_KICKS):
            if len(self.prints[bucket]) < SLOTS:
                self.prints[bucket].append(mark)
                self.keys[bucket].append(entry)
                return
            out = kick % SLOTS
            self.prints[bucket][out], mark = mark, self.prints[bucket][out]
            self.keys[bucket][out], entry = entry, self.keys[bucket][out]
            bucket = self._other(bucket, mark)
        stored = [e for held in self.keys for e in held] + [entry]
        self.resizes += 1
        self._clear(2 * (self.mask + 1))
        for key, kept in stored:
            self.insert(key, kept)

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        for held in self.keys:
            yield from held


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim("exact_dedup", nothing)
    for batch in batches:
        digests = [hashlib.sha256(t.translate(LOWER_ASCII)).digest() for t in texts_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(digests, pa.binary())], ["doc_id", "digest"]
        )


def _later(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of one task: a digest, its greatest doc_id and its rows."""

    def flush(held: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(held), pa.binary()),
                pa.array([v[0] for v in held.values()], pa.int64()),
                pa.array([v[1] for v in held.values()], pa.int64()),
            ],
            ["digest", "keep_id", "group_size"],
        )

    held: dict[bytes, tuple[int | None, int]] = {}
    for batch in batches:
        for doc, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            top, n = held.get(digest, (None, 0))
            held[digest] = (_later(top, doc), n + 1)
        if len(held) >= FOLD_ROWS:
            yield flush(held)
            held = {}
    if held:
        yield flush(held)


def _index(entries: pa.Table) -> pa.Table:
    """One index shard: insert, verify, replace the live document of a group."""
    index = CuckooIndex()
    columns = (entries.column(c).to_pylist() for c in ("digest", "keep_id", "group_size"))
    for digest, doc, n in zip(*columns, strict=True):
        live = index.get(digest)
        if live is not None:
            index.delete(digest)
            doc, n = _later(live[0], doc), live[1] + n
        index.insert(digest, (doc, n))
    items = list(index.items())
    return pa.table(
        {
            "digest": pa.array([d for d, _ in items], pa.binary()),
            "keep_id": pa.array([v[0] for _, v in items], pa.int64()),
            "group_size": pa.array([v[1] for _, v in items], pa.int64()),
        }
    )


def exact_dedup(docs: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    ``removed`` (doc_id) takes documents out of the live index first: they are
    not counted, not kept and not returned.
    """
    if removed is not None:
        gone = removed.select(F.col("doc_id").alias("__gone")).distinct()
        docs = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__gone")), "left_anti")
    digests = materialize(
        docs.select("doc_id", "text").mapInArrow(_digests, "doc_id bigint, digest binary"), "digests"
    )
    shards = max(1, -(-digests.count() // INDEX_ROWS))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")
    schema = "digest binary, keep_id bigint, group_size bigint"
    entries = digests.mapInArrow(_fold, schema).withColumn("shard", shard)
    groups = entries.groupBy("shard").applyInArrow(_index, schema)
    return digests.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
