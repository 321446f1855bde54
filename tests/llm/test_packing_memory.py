"""What a packing task keeps."""

from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from quotelake.llm import common, encode, packing

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_texts_are_encoded_about_a_megabyte_at_a_time():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "text": ["a word " * 2000] * 400})
    cut = list(common.regroup([batch], "text", packing.BATCH_BYTES))
    assert sum(b.num_rows for b in cut) == 400
    assert max(sum(map(len, b.column("text").to_pylist())) for b in cut) <= 1 << 20


def test_an_operator_that_leaves_gives_its_pages_back(monkeypatch):
    given = []
    monkeypatch.setattr(common, "_claimed", {})
    monkeypatch.setattr(common, "trim", lambda: given.append(1))
    common.claim("first", common.nothing)
    assert not given
    common.claim("second", common.nothing)
    assert given == [1]


def test_texts_at_hand_in_arrow_are_not_converted_again(monkeypatch):
    texts = ["two  spaces", None, "a\nline \tand more ", "", "plain words", "<|endoftext|> x", "\x1c odd \x1c"]
    column = pa.array(["before", *texts], pa.string()).slice(1)
    given = [t or "" for t in texts]
    library = Tokenizer.from_file(BPE)
    made = []
    monkeypatch.setattr(encode.pa, "array", lambda *a, f=pa.array: made.append(a[1:]) or f(*a))
    ids, bounds = encode.CachedEncoder(BPE, added=True).encode(given, 0, column)
    # Only what stands beside an added token.
    assert made.count((pa.large_string(),)) == 1
    for text, a, b in zip(given, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == [*library.encode(text, add_special_tokens=False).ids, 0]


def test_pages_are_given_back_every_few_runs(monkeypatch):
    given = []
    monkeypatch.setattr(packing, "trim", lambda: given.append(1))
    monkeypatch.setattr(packing, "RUN_IDS", 1)
    monkeypatch.setattr(packing, "BATCH_BYTES", 1)
    monkeypatch.setattr(packing.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(9)), "text": ["some words"] * 9})
    pieces = list(packing._runs(BPE, 0)([batch]))
    assert sum(p.num_rows for p in pieces) >= 9 and len(given) == 9 // packing.TRIM_RUNS
