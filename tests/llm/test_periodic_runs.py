"""Periodic runs against a scan of every period."""

import hashlib
import random
import zlib

import pytest

from quotelake.llm import periodic_runs as pr
from tests.conftest import rows
from tests.llm.conftest import edge_rows


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                if not any(all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_words(doc, text):
    words = (text or "").encode().split()
    if doc is None or not words or zlib.crc32(str(doc).encode()) % 10:
        return words
    g, n = zlib.crc32(str(doc).encode()) // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_digest(doc, text):
    words = brute_words(doc, text)
    runs = brute_runs(words)
    top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc, len(runs), *best, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def periodic_text(rng):
    words = []
    for _ in range(rng.randrange(9)):
        unit = [rng.choice("abcd") for _ in range(rng.randrange(1, 7))]
        words += (unit * 9)[: rng.randrange(1, 8 * len(unit))]
    return " ".join(words)


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_small_alphabets(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = [periodic_text(rng).encode().split() for _ in range(rng.randrange(5))]
        assert pr.runs_of(texts) == [brute_runs(t) for t in texts]


def test_automaton_alone_finds_all_runs():
    rng = random.Random(6)
    for _ in range(150):
        words = [ord(c) for c in periodic_text(rng).replace(" ", "")]
        assert pr.word_runs(words) == brute_runs(words)


def test_digests(spark, docs, no_docs):
    rng = random.Random(8)
    extra = [(i, periodic_text(rng)) for i in range(1000, 1120)]
    # Rewritten documents of many words, of few and of none.
    chosen = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    extra += [(d, " ".join(f"w{k}" for k in range(5 * j))) for j, d in enumerate(chosen)]
    extra += [(3001, "tick " * 4000), (3002, "a b " * 900 + "c d e \x1c f")]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    expected = sorted(map(str, [brute_digest(r[0], r[1]) for r in [*edge_rows(), *extra]]))
    assert sorted(str(tuple(r)) for r in pr.run_digests(frame).collect()) == expected
    assert pr.run_digests(docs).count() == len(edge_rows())
    assert pr.run_digests(no_docs).collect() == []


def test_general_output(spark):
    text = "start  " + "one two " * 5 + "end"
    found = rows(pr.periodic_runs(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string")), "doc_id")
    assert found[0]["runs"] == [{"start": 1, "length": 10, "period": 2}] and found[0]["n_words"] == 12
    assert found[0]["collapsed"] == "start one two end"
    assert found[1] == {"doc_id": 2, "n_words": 0, "runs": [], "collapsed": ""}
