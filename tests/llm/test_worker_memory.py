"""What the pipeline's Python workers hold at once."""

import public_tokenizers
import pyarrow as pa

from quotelake.llm import common, decontamination, encode

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_batches_are_cut_without_copying_their_texts(monkeypatch):
    def copied(column):
        raise AssertionError("texts were copied")

    monkeypatch.setattr(common, "texts_of", copied)
    texts = ["ab", None, "é" * 3, "", "x" * 9, "yz", None]
    for kind in (pa.string(), pa.large_string()):
        batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(["before", *texts], kind)], ["doc_id", "text"]).slice(1)
        cut = list(common.regroup([batch, batch.slice(0, 0)], "text", 8))
        assert [b.column("text").to_pylist() for b in cut] == [["ab", None, "é" * 3, ""], ["x" * 9], ["yz", None]]
        assert [b.column("doc_id").to_pylist() for b in cut] == [[1, 2, 3, 4], [5], [6, 7]]


def test_an_encoder_keeps_a_bounded_number_of_units_and_a_batch():
    own = encode.CachedEncoder(BPE, added=True)
    most = 0
    for at in range(0, 440_000, 20_000):
        own.encode([" ".join(f"w{n}" for n in range(at, at + 20_000))], 0)
        most = max(most, len(own.starts))
    assert 250_000 < most < 350_000


def test_few_items_meet_a_few_megabytes_of_texts_at_a_time():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(900)), "text": ["a word " * 2000] * 900})
    cut = list(decontamination._together([batch], [("item", b"some words")]))
    assert sum(b.num_rows for b in cut) == 900
    assert max(sum(map(len, b.column("text").to_pylist())) for b in cut) <= 4 << 20
