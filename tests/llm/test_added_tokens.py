"""Texts that hold an added token, against one plain call of the tokenizers library per text."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quotelake.llm import packing, token_store
from quotelake.llm.encode import encoder
from tests.conftest import rows

BPE = public_tokenizers.path("byte_bpe_50k.json")
MARK = "<|endoftext|>"
TEXTS = [
    f"a b.{MARK} c", MARK, f"{MARK}{MARK}", f" {MARK} ", f"one\n{MARK}\n two  {MARK}", f"x{MARK}y z", "<|endoftext|", "no mark",
    f"{MARK}lead  {MARK[:-1]} tail \n", "",
]


def plain(text):
    return Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids


def test_encoder_reads_added_tokens():
    rng = random.Random(4)
    parts = [" ", "\n", "ab", ".", "é", "  ", MARK, "<|", "|>", "　"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(40)) for _ in range(40)]
    for _ in range(2):
        ids, bounds = encoder(BPE, added=True).encode(texts, 7)
        for text, a, b in zip(texts, bounds, bounds[1:], strict=False):
            assert ids[a:b].tolist() == [*plain(text), 7]


def test_store_and_packing_read_added_tokens(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    own = {i: np.array([*plain(t), 2], "<u4") for i, t in enumerate(TEXTS)}
    starts = dict(zip(own, np.cumsum([0, *map(len, own.values())]).tolist(), strict=False))
    found = token_store.token_digest(docs, BPE, 2, str(tmp_path / "a"))
    assert Counter(tuple(r) for r in found.collect()) == Counter(
        (i, starts[i], len(ids), zlib.crc32(ids.tobytes())) for i, ids in own.items()
    )
    for r in rows(packing.pack_documents(docs, BPE, 2)):
        ids = own[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
