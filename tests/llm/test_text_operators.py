"""Operators on single texts and groups of equal texts, against plain Python."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotelake.llm import decontamination as dc
from quotelake.llm import exact_dedup as ed
from quotelake.llm import packing, sharding, suffix_dedup, token_store
from quotelake.llm.chat import format_chats
from quotelake.llm.encode import encoder
from tests.conftest import rows
from tests.llm.conftest import edge_rows

BPE = public_tokenizers.path("byte_bpe_50k.json")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(BPE)
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def test_encoder_is_the_tokenizer(tokenizer):
    rng = random.Random(2)
    texts = [r[1] for r in edge_rows()]
    texts += ["it's  we'll\n\nok <|endoftext|> end", "a\x1c b\u0085 c", " lead", "tail  ", "\n", "a\n\n b", None]
    texts += ["".join(rng.choice(" \n\tab.,'s1é日\x1d　!") for _ in range(60)) for _ in range(200)]
    ids, bounds = encoder(BPE).encode([t or "" for t in texts], 7)
    for text, a, b in zip(texts, bounds, bounds[1:], strict=False):
        assert ids[a:b].tolist() == [*tokenizer(text), 7]


def test_cuckoo_index_inserts_deletes_and_resizes():
    index = ed.CuckooIndex(buckets=2)
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(500)]
    for i, d in enumerate(digests):
        assert index.get(d) is None
        index.insert(d, (i, 1))
    assert index.resizes > 0 and len(index) == 500
    assert all(index.get(d) == (i, 1) for i, d in enumerate(digests))
    assert all(index.delete(d) for d in digests[::2]) and not index.delete(digests[0])
    assert [index.get(d) is None for d in digests] == [i % 2 == 0 for i in range(500)]


def test_exact_dedup(docs, no_docs, spark):
    groups = defaultdict(list)
    for doc, text, *_ in edge_rows():
        groups[hashlib.sha256(lowered(text).encode()).hexdigest()].append(doc)
    expected = Counter()
    for digest, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        expected.update((i, top, len(ids), i == top, digest) for i in ids)
    found = ed.exact_dedup(docs)
    assert Counter(tuple(r) for r in found.collect()) == expected
    assert ed.exact_dedup(no_docs).collect() == []
    gone = spark.createDataFrame([(11,)], "doc_id bigint")
    left = {r["doc_id"]: r for r in rows(ed.exact_dedup(docs, gone))}
    assert 11 not in left and left[9]["keep_id"] == 10 and left[10]["kept"]


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_sharding_is_even_and_keeps_groups(docs, no_docs, shards):
    found = rows(sharding.balanced_shards(docs, shards))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in edge_rows()
    )
    counts = Counter(r["shard"] for r in found)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    assert {r["law"] for r in found} == {"rows"} and {r["grown_shard"] for r in found} == {None}
    assert sharding.balanced_shards(no_docs, shards).collect() == []


def test_sharding_gathers_copies(spark):
    data = [(i, f"text {i}") for i in range(300)] + [(1000 + i, f"copy {i // 3}") for i in range(90)]
    found = rows(sharding.balanced_shards(spark.createDataFrame(data, "doc_id bigint, text string"), 10))
    homes = defaultdict(set)
    for r in found:
        if r["doc_id"] >= 1000:
            homes[(r["doc_id"] - 1000) // 3].add(r["shard"])
    assert sum(len(h) == 1 for h in homes.values()) >= 25


def test_packing(docs, no_docs, tokenizer):
    found = rows(packing.pack_documents(docs, BPE))
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append(r)
        pieces[r["doc_id"]].append(r)
    padding = total = 0
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW
        padding += packing.padding(at)
        total += at
    assert padding <= 0.02 * total
    expected = Counter()
    for doc, text, *_ in edge_rows():
        expected[(doc, len(tokenizer(text)) + 1)] += len(tokenizer(text)) + 1
    ids = defaultdict(int)
    for doc, held in pieces.items():
        for r in held:
            ids[(doc, r["doc_tokens"])] += r["length"]
    assert ids == expected
    one = [*tokenizer(edge_rows()[12][1]), 0]
    for r in pieces[12]:
        part = np.array(one[r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes())
    assert packing.pack_documents(no_docs, BPE).collect() == []


def test_packing_cuts_at_boundaries():
    places = np.array([0, 500, 1000, 1024, 2000, 2048, 2100])
    ends = packing.best_cuts(places, np.zeros(len(places), int))
    assert ends[:2] == [1024, 2048] and ends[-1] == 2100
    assert sum(packing.padding(b - a) for a, b in zip([0, *ends], ends, strict=False)) == 0
    long = packing.best_cuts(np.array([0, 5000]), np.array([0, 0]))
    assert long[-1] == 5000 and max(np.diff([0, *long])) <= packing.WINDOW


def test_packing_takes_every_sentence_end():
    closes = np.array([False, True])
    ids = np.tile([0, 0, 1], 700)
    places, penalties = packing.boundaries(ids, np.array([10, 2000, 2100]), closes)
    assert places.tolist() == sorted({0, 10, 2000, *range(3, 2101, 3)})
    assert {p for p, cost in zip(places.tolist(), penalties.tolist(), strict=True) if cost == 0} == {10, 2000, 2100}
    # 1024 ids end right at a sentence's end, which shares its 32 ids with a later one.
    ids = np.zeros(3000, np.int64)
    ids[[1023, 1030, 2047, 2054]] = 1
    assert packing.best_cuts(*packing.boundaries(ids, np.array([3000]), closes))[:2] == [1024, 2048]


@pytest.mark.parametrize("gap", [3, 40, 300, 1000])
def test_packing_cuts_cost_least(gap):
    rng, window = np.random.default_rng(gap), packing.WINDOW
    for _ in range(20):
        inside = np.cumsum(rng.integers(1, gap + 1, 4000 // gap))
        # A last document of a window leaves nothing for the end of the run to split.
        places = np.concatenate([[0], inside, inside[-1:] + window])
        penalties = np.concatenate([rng.choice([0, 1, 4], len(places) - 2), [0, 0]])
        least = [0] * len(places)
        for j in range(1, len(places)):
            found = []
            for i in range(j):
                length = int(places[j] - places[i])
                more = (length - 1) // window
                if more < packing.QUEUES:
                    cost = packing.padding(length) if not more and length >= 16 else (more + 1) * window - length
                    found.append(least[i] + cost + more * packing.INNER_CUT + (more + 1) * packing.SEQUENCE)
            least[j] = min(found) + int(penalties[j])
        cuts = packing.best_cuts(places, penalties)
        known = dict(zip(places.tolist(), penalties.tolist(), strict=True))
        cost = sum(known.get(c, packing.INNER_CUT) + packing.SEQUENCE for c in cuts)
        cost += sum(packing.padding(b - a) for a, b in zip([0, *cuts], cuts, strict=False))
        assert cost <= least[-1]


def test_token_shards_round_trip(docs, no_docs, tokenizer, tmp_path):
    found = sorted((tuple(r) for r in token_store.token_digest(docs, BPE, 2, str(tmp_path / "a")).collect()), key=lambda r: r[1])
    ids = [r[0] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for _, start, n, _ in found:
        assert start == at
        at += n
    expected = Counter()
    for doc, text, *_ in edge_rows():
        own = np.array([*tokenizer(text), 2], "<u4")
        expected[(doc, len(own), zlib.crc32(own.tobytes()))] += 1
    assert Counter((d, n, c) for d, _, n, c in found) == expected
    assert token_store.token_digest(no_docs, BPE, 2, str(tmp_path / "b")).collect() == []
    file = next(f for f in sorted(os.listdir(tmp_path / "a")) if f.endswith(".ids"))
    shard = token_store.TokenShard(f"file://{tmp_path}/a", f"{tmp_path}/a/{file}")
    keys = np.unique(shard.keys)
    first, records = shard.find(keys)
    assert (shard.keys[first] == keys).all() and records.sum() == shard.meta["docs"]
    absent = np.arange(10**6, 10**6 + 500)
    assert (shard.find(absent)[0] == -1).all()


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000))
    slots = token_store.PerfectHash.build(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def brute_hits(text, items):
    split = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t).encode())
    words = split(text)
    marks, found = [0] * len(words), set()
    for name, item in items:
        own = split(item)
        width = min(13, len(own))
        for k in range(len(own) - width + 1) if own else ():
            for at in range(len(words) - width + 1):
                if words[at : at + width] == own[k : k + width]:
                    marks[at : at + width] = [1] * width
                    found.add(name)
    names = ",".join(sorted(str(n) for n in found if n is not None))
    hit = sum(marks)
    digest = hashlib.sha256(names.encode()).hexdigest()
    return len(words), hit, len(found - {None}), digest, hit > 0 and 20 * hit >= len(words)


def test_decontamination(docs, no_docs, spark, monkeypatch):
    base = edge_rows()[9][1].split()
    items = [
        (1, " ".join(base[3:20])), (2, "one TWO"), (3, ""), (4, None), (None, "three w"), (5, " ".join(base[40:52])),
        (12, "a b c d"), (6, "b c"), (2, "one two"), (7, " ".join(["x"] * 30)), (8, "日本"), (9, " ".join(base[50:80])),
    ]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    extra = [(100, "see three w and one two a b c"), (101, " ".join(["x"] * 14)), (102, " ".join(base[45:70]) + " q " * 500)]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    expected = Counter(
        (d, *brute_hits(t, items)) for d, t in [*((r[0], r[1]) for r in edge_rows()), *extra]
    )
    assert Counter(tuple(r) for r in dc.decontaminate(more, benchmark).collect()) == expected
    assert dc.decontaminate(no_docs, benchmark).collect() == []
    none = dc.decontaminate(docs, benchmark.limit(0)).where("n_hit > 0 OR contaminated")
    assert none.count() == 0
    clean = {r["doc_id"]: r["clean"] for r in rows(dc.decontaminate(more, benchmark, cleaned=True)) if r["doc_id"] is not None}
    assert clean[100].split() == ["see", "and", "a"] and clean[19] == edge_rows()[19][1]
    kept = dc.keep_uncontaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(
        n for r, n in Counter((d, *brute_hits(t, items)) for d, t, *_ in edge_rows()).items() if not r[-1]
    )


def test_automaton_blocks_agree(monkeypatch):
    items = [(str(i), " ".join(f"t{i}w{k % 17}" for k in range(20)).encode()) for i in range(30)]
    texts = [items[3][1] + b" and " + items[9][1], b"nothing"]
    whole = dc._hits(texts, items, 13)
    monkeypatch.setattr(dc, "BLOCK_WORDS", 50)
    assert dc._hits(texts, items, 13) == whole and whole[1][0] == {"3", "9"}


def brute_repeats(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        marks = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                marks[i : i + length] = b"\x01" * length
        kept = bytes(b for b, m in zip(t, marks, strict=True) if not m)
        spans = sum(m and (i == 0 or not marks[i - 1]) for i, m in enumerate(marks))
        out.append((len(t), sum(marks), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("many", [200, 1])
def test_suffix_dedup(docs, no_docs, spark, monkeypatch, many):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefg ") for _ in range(450))
    extra = [
        (200 + i, "".join(rng.choice("hijkl ") for _ in range(rng.randrange(500))) + passage[: 380 + 10 * i] + "tail" * i)
        for i in range(8)
    ]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    data = [(d, (t or "").encode()) for d, t in [*((r[0], r[1]) for r in edge_rows()), *extra]]
    expected = Counter((d, *r) for (d, _), r in zip(data, brute_repeats([t for _, t in data], 400), strict=True))
    assert Counter(tuple(r) for r in suffix_dedup.remove_repeats(more).collect()) == expected
    whole = suffix_dedup.remove_repeats(more, with_text=True)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in rows(whole))
    assert suffix_dedup.remove_repeats(no_docs).collect() == []


def test_suffix_order():
    rng = random.Random(3)
    for size in (1, 2, 50, 700):
        text = bytes(rng.choice(b"ab\x00\xff") for _ in range(size))
        order = suffix_dedup.suffix_order(text, np.ones(size, bool), 800).tolist()
        assert order == sorted(range(size), key=lambda i: text[i:])
        wanted = np.array([rng.random() < 0.3 for _ in range(size)])
        part = suffix_dedup.suffix_order(text, wanted, 800).tolist()
        assert part == [i for i in order if wanted[i]]


def test_chats(spark):
    log = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", None),
        (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", ""),
        (4, 0, "user", "hi"), (4, 0, "user", "other"), (4, 0, "user", "other"),
        (None, 5, None, "alone"), (5, None, "user", "first"), (5, 1, "user", "second"), (6, 3, "user", "hi"),
    ]
    frame = spark.createDataFrame(log, "conv_id bigint, turn bigint, role string, text string")
    frame = frame.withColumn("pos", F.lit("clash"))
    found = rows(format_chats(frame, turns_per_part=2))
    assert {(r["conv_id"], r["n_turns"], r["copies"]) for r in found} == {(2, 3, 2), (4, 3, 1), (None, 1, 1), (5, 2, 1)}
    two = {r["part"]: r["rendered"] for r in found if r["conv_id"] == 2}
    assert two == {
        0: "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n",
        1: "<|im_start|>user\n<|im_end|>\n",
    }
    assert format_chats(frame.limit(0)).collect() == []
