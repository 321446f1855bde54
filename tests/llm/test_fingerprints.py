"""Locally consistent parsing against a plain parser, and the query against plain Python."""

import hashlib
import random

import pytest

from quotelake.llm import fingerprints as fp
from tests.conftest import rows
from tests.llm.conftest import edge_rows, words

MASK = (1 << 64) - 1


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def toss(left, own):
    place = ((left ^ own) & -(left ^ own)).bit_length() - 1
    return 2 * place + ((own >> place) & 1)


def plain_level(symbols, level):
    own, runs = [], []
    for x in symbols:
        if own and own[-1] == x:
            runs[-1] += 1
        else:
            own.append(x)
            runs.append(1)
    labels = own
    for _ in range(4 if level else 3):
        labels = [toss(labels[i - 1] if i else labels[i] ^ 1, labels[i]) for i in range(len(labels))]
    assert all(v < 6 for v in labels) and all(a != b for a, b in zip(labels, labels[1:], strict=False))
    starts = [0] + [i for i in range(1, len(own) - 1) if labels[i - 1] < labels[i] > labels[i + 1]]
    names = []
    for a, b in zip(starts, [*starts[1:], len(own)], strict=True):
        parts = [mix((own[i] + runs[i] * 0xD1B54A32D192ED03) & MASK) * pow(0x9E3779B97F4A7C15, i - a + 1, 1 << 64) for i in range(a, b)]
        names.append(mix((sum(parts) + (level + 1) * 0x8CB92BA72F3D8DD7) & MASK))
    return names


def plain_fingerprint(text):
    if not text:
        return ""
    symbols, level, kept = list(text), 0, []
    while level == 0 or len(symbols) > 1:
        symbols = plain_level(symbols, level)
        if level < fp.LEVELS:
            kept.append(symbols)
        level += 1
    top = max((k for k, names in enumerate(kept) if len(names) >= fp.ENOUGH), default=0)
    lists = [sorted({v >> 24 for v in kept[k]})[: fp.KEPT] for k in (top, top - 1) if k >= 0]
    return ".".join([f"{mix((symbols[0] + level) & MASK):016x}", str(top + 1), *["".join(f"{v:010x}" for v in p) for p in lists]])


@pytest.mark.parametrize("piece", [1 << 20, 64])
def test_fingerprints_are_those_of_the_plain_parser(monkeypatch, piece):
    monkeypatch.setattr(fp, "PIECE", piece)
    rng = random.Random(3)
    for _ in range(60):
        alphabets = [b"a", b"ab", bytes(range(97, 123)), bytes(range(256))]
        texts = [
            bytes(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 3, 10, 300, 2000])))
            for alphabet in rng.choices(alphabets, k=rng.randrange(1, 6))
        ]
        assert fp.fingerprints(texts) == [plain_fingerprint(t) for t in texts]


def test_equal_substrings_share_interior_names():
    rng = random.Random(4)
    common = words(rng, 400).encode()
    for _ in range(20):
        one, two = (words(rng, rng.randrange(1, 60)).encode() + common + words(rng, 30).encode() for _ in range(2))
        levels, _ = fp.parse([common, one, two])
        for level, edge in ((0, 6), (1, 6), (2, 8)):
            inner = levels[0][level][edge:-edge].tolist()
            for other in (levels[1][level].tolist(), levels[2][level].tolist()):
                assert any(other[i : i + len(inner)] == inner for i in range(len(other)))


def test_likeness():
    rng = random.Random(5)
    text = words(rng, 900)
    changed = text.replace(" w1", " v2")[: -len(text) // 10]
    far = words(rng, 900, 10_000)
    one, near, other, empty, tiny = fp.fingerprints([t.encode() for t in (text, changed, far, "", "ab")])
    assert fp.likeness(one, one) == fp.likeness(empty, empty) == 1
    assert 0.1 < fp.likeness(one, near) < 1 and fp.likeness(one, near) == fp.likeness(near, one)
    assert fp.likeness(one, other) < 0.1 and fp.likeness(one, empty) == 0 == fp.likeness(tiny, one)


def plain_rows(data):
    """Descending doc_id, nulls last; rows of one id must be alike in text or be given in order."""
    out = []
    for i, (doc, text) in enumerate(data):
        after = data[(i + 1) % len(data)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        own, new, nxt = fp.fingerprints([t.encode() for t in (text, edited, after)])
        out.append(
            (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, new, fp.likeness(own, new), fp.likeness(own, nxt))
        )
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 30, 2000, 1])
def test_compare_with_next(spark, block):
    data = sorted({r[0]: r[1] or "" for r in edge_rows() if r[0] is not None}.items(), reverse=True)
    frame = spark.createDataFrame([(d, t or None) for d, t in data], "doc_id bigint, text string").repartition(5)
    assert sorted(tuple(r) for r in fp.compare_with_next(frame, block).collect()) == plain_rows(data)


@pytest.mark.parametrize("block", [1 << 30, 500])
def test_repeated_and_null_ids(docs, no_docs, spark, block):
    found = rows(fp.compare_with_next(docs, block))
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in edge_rows())
    assert {r["fingerprint"] for r in found} == set(fp.fingerprints([(r[1] or "").encode() for r in edge_rows()]))
    assert fp.compare_with_next(no_docs, block).collect() == []
    same = spark.createDataFrame([(4, "abc def ghi")] * 7, "doc_id int, text string")
    assert [r["near_next"] for r in rows(fp.compare_with_next(same, block))] == [1.0] * 7
    alone = rows(fp.compare_with_next(same.limit(1), block))
    assert alone[0]["edited_sha256"] == hashlib.sha256(b"abc def abc").hexdigest()


def test_document_fingerprints(docs):
    expected = sorted((str(r[0]), plain_fingerprint((r[1] or "").encode())) for r in edge_rows())
    assert sorted((str(r[0]), r[1]) for r in fp.document_fingerprints(docs).collect()) == expected
