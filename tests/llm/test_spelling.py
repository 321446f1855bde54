"""Spelling variants against comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quotelake.llm import spelling
from tests.conftest import rows
from tests.llm.conftest import edge_rows


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[p:] == b[p + 1 :] or (len(a) == len(b) and a[p + 1 :] == b[p + 1 :])


def brute_counts(docs, every):
    n = Counter()
    for doc, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return n


def brute_variants(docs, every, points, least):
    n = {w: c for w, c in brute_counts(docs, every).items() if len(w) >= points and c >= least}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        top = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def typed(found):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found}


def noisy_docs(seed, count=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcéÿ") for _ in range(rng.randrange(5, 10))) for _ in range(40)] + ["aaaaaaa", "Äpfelchen"]
    docs = []
    for i in range(count):
        words = []
        for _ in range(300):
            # Few stems are frequent; edits of edits make chains.
            word = stems[int(len(stems) * rng.random() ** 4)]
            while rng.random() < 0.3:
                at = rng.randrange(len(word) + 1)
                word = word[:at] + rng.choice(["", "a", "c"]) + word[at + rng.randrange(2) :]
            words.append(word.upper() if rng.random() < 0.2 else word)
        docs.append((i, rng.choice([" ", "-", "1 "]).join(words)))
    return docs


@pytest.mark.parametrize(("seed", "crowd"), [(1, spelling.CROWD), (2, 4), (3, 1)])
def test_variants(spark, seed, crowd):
    docs = noisy_docs(seed)
    expected = brute_variants(docs, 19, 4, 2)
    assert len(expected) > 300 and len({r[2] for r in expected if r[1]} - {r[1] for r in expected}) == 0
    assert any(r[2] != (r[1] or r[0]) for r in expected)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    found = rows(spelling.spelling_variants(frame, 19, 4, 2, crowd=crowd))
    assert len(found) == len(expected) and typed(found) == expected


def test_edge_rows(docs, no_docs):
    found = rows(spelling.spelling_variants(docs, spelling.TYPO_EVERY, 1, 1))
    assert typed(found) == brute_variants(edge_rows(), spelling.TYPO_EVERY, 1, 1)
    assert spelling.spelling_variants(no_docs).collect() == []


def test_long_texts_are_read_in_steps(spark, monkeypatch):
    docs = noisy_docs(5, 4) + [(77, "x" * 5000)]
    monkeypatch.setattr(spelling, "LONG_TEXT", 10)
    monkeypatch.setattr(spelling, "HELD_WORDS", 7)
    count = spelling._count(19, 1)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], ["doc_id", "text"])
    found = Counter()
    for part in count(iter([batch])):
        for row in part.to_pylist():
            found[row["word"]] += row["n"]
    assert found == Counter({w: c for w, c in brute_counts(docs, 19).items() if w})


@pytest.mark.parametrize("seeds", [1 << 20, 3])
def test_composition_accepts_each_pair_once(monkeypatch, seeds):
    monkeypatch.setattr(spelling, "SEEDS", seeds)
    rng = random.Random(9)
    for _ in range(60):
        words = sorted({bytes(rng.choice(b"ab\xff") for _ in range(rng.randrange(1, 7))) for _ in range(80)})
        groups = np.zeros(len(words), np.int64)
        whole = spelling.minimal_acceptor(groups, words)
        # Minimal: no two states have the same future.
        futures = [
            (bool(whole.final[s]), tuple(zip(whole.byte[b : b + m], whole.target[b : b + m], strict=True)))
            for s, (b, m) in enumerate(zip(whole.begin, whole.moves, strict=True))
        ]
        assert len(set(futures)) == len(futures) < len(whole.node_state)
        pairs = Counter()
        for one, two in spelling.near_pairs(whole, np.array([99]), np.array([0]), np.array([99])):
            pairs.update(frozenset(p) for p in zip(one.tolist(), two.tolist(), strict=True))
        expected = {frozenset((i, j)) for i in range(len(words)) for j in range(i) if one_edit(words[i], words[j])}
        assert set(pairs) == expected and set(pairs.values()) <= {1}
