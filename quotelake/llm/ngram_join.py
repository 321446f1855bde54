"""Jaccard join on word shingles with token-combination prefixes.

A token is a hashed shingle. Each document's tokens are put in one global
order: tokens no other document has, then rarer before more frequent. A set of
n tokens may miss at most n - ceil(t n) of them in any partner, so a prefix
longer than that shares something with every partner:

* tokens of one document only stand first and can never be shared; documents
  with more of them than they may miss have no partner and leave here;
* rare tokens are indexed singly and lengthen the prefix by one each;
* frequent tokens are indexed as pairs. They are dealt to subclasses by hash;
  if two sets share no pair of a subclass, they share at most one token of it,
  so every token of a subclass but its first lengthens the prefix by one, and
  the prefix is extended until that suffices.

The number of subclasses follows the size of the sets (by powers of two; a set
is indexed at the one or two levels its partners can have), so there are about
as many pairs as tokens in a prefix.

Frequencies are counted over all documents. Tasks send the tokens of a batch of
documents as packed arrays, cut by token range; a range's task returns those
that several documents have, with their frequency, to the batch they came from.
So the corpus crosses the network as arrays, and later steps hold only
documents that may have partners, with the tokens that a partner can share.
Those suffice to verify a pair. What is compared is 40 bits of a token's hash
and the bits of its range (none below 6 MB of text, 13 for 50 GB): two sets of
500 tokens agree on a token by chance with odds of one in four million at
least, and in 36 thousand million at 50 GB; a link is then wrong only where
one token decides.

Equal token sets are one class. Of each bucket of the index the member with
the fewest tokens that may be missed is the hub; every class is first verified
against its best hub. Linked classes are joined into components, and what
is left to compare is pairs of one bucket from different components whose
sizes and positions allow a link. They are verified too, so no link that
could join components is left out, and copies are never expanded into pairs.

Defined results: words are runs of other than ASCII white space, A-Z
lower-cased; fewer words than a shingle are one token; null text and text
without words are an empty set, linked with nothing; repeated rows are equal
sets; component_id ignores null doc_ids and is null where a component has no
other; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import LOWER_ASCII, claim, materialize, regroup, texts_of
from quotelake.llm.components import components

BATCH_BYTES = 5 << 20
RANGE_BYTES = 6 << 20
MAX_WORDS = 250_000
FREQUENT = 64
# Sets below this size have no token pairs.
PAIRS_FROM = 16
U64 = np.uint64
MULTIPLIERS = np.array(
    [pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(16)], np.uint64
)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = value
        return value


_words = _WordHashes()


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = text.translate(LOWER_ASCII).split()
    if not words:
        return np.zeros(0, U64)
    hashes = np.fromiter(map(_words.__getitem__, words), U64, len(words))
    width = min(size, len(words))
    count = len(words) - width + 1
    with np.errstate(over="ignore"):
        mixed = np.zeros(count, U64)
        for i in range(width):
            mixed = mix(mixed * MULTIPLIERS[0] + hashes[i : i + count] + U64(i + 1))
        if width < size:
            mixed = mix(mixed + U64(width) * MULTIPLIERS[1])
    return np.unique(mixed)


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose rows two bytes can number."""
    for batch in batches:
        for at in range(0, batch.num_rows, MOST):
            yield batch.slice(at, MOST)


# A token is cut into its range (upper bits) and the next 40 bits, which are sent.
def _send(size: int, bits: int):
    """Per batch and token range: tokens of the range, and the steps from document to document."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ngram_join", _words.clear)
        task = TaskContext.get().partitionId() << 32
        for at, batch in enumerate(_short(regroup(batches, "text", BATCH_BYTES))):
            sets = [shingle_set(t, size) for t in texts_of(batch.column("text"))]
            sizes = np.array([len(s) for s in sets], np.int64)
            tokens = np.concatenate([*sets, np.zeros(0, U64)])
            # Sums of differently mixed tokens tell sets apart: 128 bits.
            starts = np.concatenate([[0], np.cumsum(sizes)])
            prints = []
            for seed in (1, 2):
                with np.errstate(over="ignore"):
                    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(tokens * MULTIPLIERS[seed]))])
                    prints.append((sums[starts[1:]] - sums[starts[:-1]]).view(np.int64))
            doc = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
            del sets, sums
            ranges = (tokens >> U64(64 - bits)).astype(np.uint32) if bits else np.zeros(len(tokens), np.uint32)
            order = np.argsort(ranges, kind="stable")
            bounds = np.searchsorted(ranges[order], np.arange((1 << bits) + 1))
            tokens, doc = tokens[order], doc[order]
            del ranges, order
            about = pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes), pa.array(prints[0]), pa.array(prints[1])],
                ["doc_id", "n", "f0", "f1"],
            )
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, about.schema) as writer:
                writer.write_batch(about)
            rows = {"batch": [], "range": [], "low": [], "high": [], "doc": [], "about": []}
            # The documents' records ride with one range, another one for each batch.
            home = int(mix(np.array([task | at], U64))[0]) % (1 << bits)
            for r in range(1 << bits):
                part = slice(int(bounds[r]), int(bounds[r + 1]))
                if r != home and part.start == part.stop:
                    continue
                sent = tokens[part] << U64(bits) >> U64(24)
                rows["batch"].append(task | at)
                rows["range"].append(r)
                rows["low"].append((sent & U64(0xFFFFFFFF)).astype("<u4").tobytes())
                rows["high"].append((sent >> U64(32)).astype("u1").tobytes())
                rows["doc"].append(np.diff(doc[part], prepend=0).astype("<u2").tobytes())
                rows["about"].append(sink.getvalue().to_pybytes() if r == home else None)
            yield pa.RecordBatch.from_pydict(rows, schema=SENT)

    return send


SENT = pa.schema(
    [
        ("batch", pa.int64()), ("range", pa.int64()), ("low", pa.binary()), ("high", pa.binary()),
        ("doc", pa.binary()), ("about", pa.binary()),
    ]
)
SENT_DDL = "batch bigint, range bigint, low binary, high binary, doc binary, about binary"
ANSWER_DDL = "batch bigint, range bigint, low binary, high binary, count binary, doc binary, about binary"
MOST = 0xFFFF


def _sent(low: bytes, high: bytes) -> np.ndarray:
    """The 40 bits of each token that were sent."""
    return np.frombuffer(low, "<u4").astype(U64) | np.frombuffer(high, "u1").astype(U64) << U64(32)


def _whole(low: bytes, high: bytes, token_range: int, bits: int) -> np.ndarray:
    """The tokens, with the bits of their range in front."""
    rest = _sent(low, high) << U64(24) >> U64(bits)
    return rest | (U64(token_range) << U64(64 - bits)) if bits else rest


def _frequencies():
    """Of one token range: the tokens that several documents have, back to their batches."""

    def count(table: pa.Table) -> pa.Table:
        low, high = table.column("low").to_pylist(), table.column("high").to_pylist()
        parts = [_sent(a, b) for a, b in zip(low, high, strict=True)]
        tokens = np.concatenate(parts)
        order = np.argsort(tokens)
        ranked = tokens[order]
        first = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, bool)
        begins = np.flatnonzero(first)
        counts = np.diff(np.concatenate([begins, [len(ranked)]]))
        found = np.empty(len(tokens), np.int64)
        found[order] = np.repeat(counts, counts)
        out = {name: [] for name in ("batch", "range", "low", "high", "count", "doc", "about")}
        for name in ("batch", "range", "about"):
            out[name] = table.column(name).to_pylist()
        at = 0
        for part, docs in zip(parts, table.column("doc").to_pylist(), strict=True):
            n = found[at : at + len(part)]
            at += len(part)
            shared = n > 1
            doc = np.cumsum(np.frombuffer(docs, "<u2").astype(np.int64))[shared]
            out["low"].append((part[shared] & U64(0xFFFFFFFF)).astype("<u4").tobytes())
            out["high"].append((part[shared] >> U64(32)).astype("u1").tobytes())
            # Frequencies only put tokens in order: above this they are all alike.
            out["count"].append(np.minimum(n[shared], MOST).astype("<u2").tobytes())
            out["doc"].append(np.diff(doc, prepend=0).astype("<u2").tobytes())
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.table({name: pa.array(v, kind) for (name, v), kind in zip(out.items(), kinds, strict=True)})

    return count


def may_miss(n: int, percent: int) -> int:
    """Tokens of a set of n that a partner may lack."""
    return n - -(-percent * n // 100)


def signatures(tokens: np.ndarray, counts: np.ndarray, n: int, percent: int) -> list[tuple[int, int]]:
    """(signature, position) of one set; ``tokens`` are those that other sets have too.

    The position of a single is that of its token in the set's order; that of
    a pair is the number of tokens before all frequent ones.
    """
    need = may_miss(n, percent) + 1
    alone = n - len(tokens)
    if alone >= need:
        return []
    order = np.lexsort((tokens, counts))
    tokens, counts = tokens[order], counts[order]
    out: list[tuple[int, int]] = []
    smallest = -(-percent * n // 100)
    for level in {n.bit_length(), smallest.bit_length()}:
        rare = len(tokens) if 1 << (level - 1) < PAIRS_FROM else int(np.searchsorted(counts, FREQUENT))
        salt = (level * 0x9E3779B97F4A7C15) & (2**64 - 1)
        with np.errstate(over="ignore"):
            single = mix(tokens[: min(rare, need - alone)] + U64(salt)).view(np.int64)
        out.extend(zip(single.tolist(), range(alone, alone + len(single)), strict=True))
        if alone + rare >= need:
            continue
        subclasses = max(1, (1 << (level - 1)) // 16)
        have, members = alone + rare, {}
        for token in tokens[rare:].tolist():
            sub = ((token * 0xD6E8FEB86659FD93 & (2**64 - 1)) >> 33) % subclasses
            mates = members.setdefault(sub, [])
            for mate in mates:
                pair = (mate * 3 + token * 5 if mate < token else token * 3 + mate * 5) & (2**64 - 1)
                out.append((pair ^ salt, alone + rare))
            have += bool(mates)
            mates.append(token)
            if have >= need:
                break
    return out


CANDIDATE_DDL = (
    "doc_id bigint, n bigint, f0 bigint, f1 bigint, tokens array<bigint>, sigs array<bigint>, places array<int>"
)


def _candidates(percent: int, bits: int):
    """Of one batch: every document, with signatures where it may have partners."""

    def gather(table: pa.Table) -> pa.Table:
        about = next(a for a in table.column("about").to_pylist() if a is not None)
        docs = pa.ipc.open_stream(about).read_all().combine_chunks()
        sizes = docs.column("n").to_numpy()
        parts = (table.column(c).to_pylist() for c in ("range", "low", "high"))
        tokens = [_whole(low, high, r, bits) for r, low, high in zip(*parts, strict=True)]
        counts = [np.frombuffer(t, "<u2") for t in table.column("count").to_pylist()]
        owner = [np.cumsum(np.frombuffer(d, "<u2").astype(np.int64)) for d in table.column("doc").to_pylist()]
        tokens, counts, owner = np.concatenate(tokens), np.concatenate(counts), np.concatenate(owner)
        order = np.lexsort((tokens, owner))
        tokens, counts = tokens[order], counts[order]
        bounds = np.searchsorted(owner[order], np.arange(len(sizes) + 1))
        kept, sigs, places = [], [], []
        for i, n in enumerate(sizes.tolist()):
            own = slice(int(bounds[i]), int(bounds[i + 1]))
            found = signatures(tokens[own], counts[own], n, percent) if n else []
            kept.append(tokens[own].view(np.int64) if found else None)
            sigs.append([s - (1 << 64) if s >= 1 << 63 else s for s, _ in found] or None)
            places.append([p for _, p in found] or None)
        return docs.append_column("tokens", pa.array(kept, pa.list_(pa.int64()))).append_column(
            "sigs", pa.array(sigs, pa.list_(pa.int64()))
        ).append_column("places", pa.array(places, pa.list_(pa.int32())))

    return gather


def _linked(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are similar enough."""
    sets = classes.select("cls", "n", "tokens")
    a = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("ta", "tb"))
    both = both.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), common.alias("common"))
    return both.where(100 * F.col("common") >= percent * (F.col("n") - F.col("common"))).select("a", "b")


def _possible(x: str, y: str, percent: int):
    """Whether sizes and positions leave room for enough common tokens."""
    nx, ny, px, py = (F.col(f"{s}.{c}") for c in ("n", "place") for s in (x, y))
    most = F.least(nx - px, ny - py)
    return (
        ((100 + percent) * most >= percent * (nx + ny))
        & (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny))
    )


def similar_documents(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; Jaccard of at least ``percent`` / 100 (50 to 100) links."""
    if not 50 <= percent <= 100:
        # Sets are indexed for partners of at most twice or half their size.
        raise ValueError("percent is 50 to 100")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About one token in six bytes, six bytes a token.
    bits = max(0, math.ceil(math.log2(max(1, size / RANGE_BYTES))))
    sent = docs.select("doc_id", "text").mapInArrow(_send(words, bits), SENT_DDL)
    answers = sent.groupBy("range").applyInArrow(_frequencies(), ANSWER_DDL)
    rows = materialize(answers.groupBy("batch").applyInArrow(_candidates(percent, bits), CANDIDATE_DDL), "sets")
    keys = ["f0", "f1", "n"]
    classes = rows.where("sigs IS NOT NULL").groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in ("tokens", "sigs", "places")]
    )
    classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    entries = classes.select("cls", "n", F.explode(F.arrays_zip("sigs", "places")).alias("e")).select(
        "cls", F.col("n").cast("int").alias("n"), F.col("e.sigs").alias("sig"), F.col("e.places").alias("place")
    )
    # A signature comes several times from a class only by chance; the first place then counts.
    entries = entries.groupBy("sig", "cls", "n").agg(F.min("place").alias("place"))
    entries = materialize(entries, "entries")
    hub = F.min(F.struct((F.col("place") / F.col("n")).alias("share"), "cls", "n", "place")).alias("hub")
    buckets = entries.groupBy("sig").agg(hub, F.count(F.lit(1)).alias("members")).where("members > 1")
    members = materialize(entries.join(buckets.drop("members"), "sig"), "members")
    own = members.select("cls", "hub", F.struct("n", "place").alias("me")).where(F.col("cls") != F.col("hub.cls"))
    stars = own.where(_possible("me", "hub", percent)).groupBy("cls").agg(F.min("hub").alias("hub"))
    stars = materialize(stars.select(F.col("cls").alias("a"), F.col("hub.cls").alias("b")), "stars")
    links = materialize(_linked(stars, classes, percent), "links")
    found = components(links)
    # What is left: members of one bucket in different components.
    placed = members.drop("hub").join(found.select(F.col("node").alias("cls"), "component"), "cls", "left")
    placed = placed.withColumn("component", F.coalesce("component", "cls"))
    open_ = placed.groupBy("sig").agg(
        F.min("component").alias("c0"),
        F.max("component").alias("c1"),
        F.mode("component").alias("most"),
        F.min("n").alias("smallest"),
    ).where("c0 < c1")
    placed = placed.join(open_.drop("c0", "c1"), "sig")
    smallest = F.greatest(F.col("smallest"), F.ceil(percent * F.col("n") / 100))
    alive = placed.where((100 + percent) * (F.col("n") - F.col("place")) >= percent * (F.col("n") + smallest))
    alive = materialize(alive.select("sig", "cls", "component", "most", F.struct("n", "place").alias("at")), "alive")
    # Members of the largest component need no comparison among themselves.
    fewer = alive.where("component <> most").select("sig", *[F.col(c).alias(f"x_{c}") for c in ("cls", "component", "at")])
    pairs = fewer.join(alive.drop("most"), "sig").where(
        (F.col("x_component") != F.col("component")) & _possible("x_at", "at", percent)
    )
    pairs = pairs.select(F.least("x_cls", "cls").alias("a"), F.greatest("x_cls", "cls").alias("b")).distinct()
    pairs = pairs.join(stars, ["a", "b"], "left_anti").join(
        stars.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti"
    )
    late = materialize(_linked(pairs, classes, percent), "links")
    if not late.isEmpty():
        found = components(links.union(late))
    # Classes that are linked share a component's smallest doc_id; others have their own.
    members = classes.select(*keys, "cls").join(found.select(F.col("node").alias("cls"), "component"), "cls")
    linked = members.select(*[F.col(k).alias(f"k_{k}") for k in keys], "component")
    same = [F.col(k) == F.col(f"k_{k}") for k in keys]
    ids = rows.groupBy(*keys).agg(F.min("doc_id").alias("least"))
    ids = materialize(ids.join(linked, same, "left").select(*keys, "least", "component"), "ids")
    tops = ids.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("top"))
    # Sets without a component are most of all: they stay out of the join.
    names = [F.col(k).alias(f"k_{k}") for k in keys]
    alone = ids.where("component IS NULL").select(*names, F.col("least").alias("component_id"))
    ids = ids.join(tops, "component").select(*names, F.col("top").alias("component_id")).union(alone)
    out = rows.join(ids, same)
    own_id = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own_id.alias("component_id"))
