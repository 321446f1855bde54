"""What used to be capped, cut or rebuilt: many languages, large benchmarks, long samples, many new words."""

import os
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from quotelake.llm import decontamination as dc
from quotelake.llm import encode, language_id, ngram_join, quality, token_store
from tests.conftest import rows
from tests.llm.conftest import edge_rows, words
from tests.llm.test_corpus_operators import brute_groups
from tests.llm.test_text_operators import brute_hits

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("block_words", [40, 3])
def test_stored_blocks_of_a_large_benchmark(docs, spark, monkeypatch, block_words):
    base = edge_rows()[14][1].split()
    rng = random.Random(6)
    items = [(1, " ".join(base[100:400])), (2, "one TWO"), (None, "three w"), (5, " ".join(base[40:52])), (6, ""), (7, None)]
    items += [(20 + i, " ".join(base[i * 50 : i * 50 + 14])) for i in range(20)] + [(5, " ".join(base[40:52]))]
    items += [(60 + i, words(rng, 30)) for i in range(20)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(dc, "BLOCK_WORDS", block_words)
    source = dc._items(benchmark, 13).value
    assert isinstance(source, dc.StoredBlocks) and len(source.paths) > 5
    expected = Counter((r[0], *brute_hits(r[1], items)) for r in edge_rows())
    assert Counter(tuple(r) for r in dc.decontaminate(docs, benchmark).collect()) == expected
    assert dc.keep_uncontaminated(docs, benchmark).count() == sum(n for r, n in expected.items() if not r[-1])


def test_reading_texts_builds_nothing(spark, monkeypatch):
    rng = random.Random(7)
    items = [(i, words(rng, 400, 9_000)) for i in range(700)]
    source = dc._items(spark.createDataFrame(items, "item_id int, text string"), 13).value
    assert sum(len(t) for _, t in items) > 4 * dc.BLOCK_WORDS and isinstance(source, dc.StoredBlocks)

    def build(*_):
        raise AssertionError("an automaton was built")

    monkeypatch.setattr(dc.Automaton, "__init__", build)
    texts = [f"see {items[5][1]}".encode(), b"", f"{items[699][1][-200:]}".encode()]
    for _ in range(2):
        marks, found = dc._hits(texts, source, 13)
        assert [m.count(1) > 12 for m in marks] == [True, False, True] and found[0] == {"5"} and found[2] == {"699"}


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "EPOCHS", 1)
    data = [(i, f"text {i} of {i % 500} words", f"lang{i % 500}") for i in range(4_000)]
    model = language_id.fit_languages(spark.createDataFrame(data, "doc_id bigint, text string, lang string"))
    assert len(model.labels) == 500


def test_without_languages_texts_with_letters_stay(docs, spark):
    frame = docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    kept = language_id.keep_identified(frame)
    letters = [r for r in edge_rows() if language_id.LETTER.search(r[1] or "")]
    assert kept.columns == frame.columns and kept.count() == len(letters) < len(edge_rows())
    assert {r["lang_pred"] for r in rows(language_id.predict_languages(frame))} == {"und"}


def test_samples_come_from_the_whole_text(spark):
    text = "".join(chr(97 + i % 26) for i in range(5_000)) + "é" * 5_000
    frame = spark.createDataFrame([(i, text) for i in range(60)] + [(99, "short")], "doc_id bigint, text string")
    found = [r[0] for r in frame.select(language_id.stretch("text", 1_000)).collect()]
    assert found.pop() == "short" and {len(t) for t in found} == {1_000}
    assert any(t.endswith("é" * 1_000) for t in found) and any("é" not in t for t in found)


def test_dictionary_is_chosen_from_all_texts():
    rng = random.Random(3)
    texts = [(words(rng, 60) + (" early phrase of some length" if i < 500 else " later words that come often")).encode() for i in range(1_500)]
    rng.shuffle(texts)
    built = quality._dictionary(texts, 8_192)
    assert len(built) <= 8_192
    with_it, without = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(built)), zstandard.ZstdCompressor()
    assert sum(len(with_it.compress(t)) for t in texts) < 0.9 * sum(len(without.compress(t)) for t in texts)
    small = [b"abc", b"defg"]
    assert quality._dictionary(small, 7) == b"abcdefg"


@pytest.mark.parametrize("range_bytes", [6 << 20, 2_000])
def test_near_copies_over_ranges(docs, monkeypatch, range_bytes):
    monkeypatch.setattr(ngram_join, "RANGE_BYTES", range_bytes)
    data = [(r[0], r[1]) for r in edge_rows()]
    found = Counter(tuple(r) for r in ngram_join.similar_documents(docs, 4, 85).collect())
    assert found == brute_groups(data, 4, 85)


def test_join_refuses_low_similarities_and_cuts_long_batches(docs):
    with pytest.raises(ValueError):
        ngram_join.similar_documents(docs, 4, 30)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(150_000))], ["doc_id"])
    parts = list(ngram_join._short(iter([batch])))
    assert max(p.num_rows for p in parts) <= 0xFFFF and pa.Table.from_batches(parts).num_rows == 150_000


def test_wrong_index_is_noticed(docs, tmp_path):
    folder = f"file://{tmp_path}/ids"
    assert token_store.token_digest(docs, BPE, 2, folder).count() == len(edge_rows())
    file = max((f for f in os.listdir(tmp_path / "ids") if f.endswith(".ids")), key=lambda f: os.path.getsize(tmp_path / "ids" / f))
    shard = token_store.TokenShard(folder, f"{tmp_path}/ids/{file}")
    owner, record = token_store.located(shard)
    assert record.tolist() == list(range(len(shard.keys))) and (owner == shard.keys).all()
    shard.first = shard.first[np.roll(np.arange(len(shard.first)), 1)]
    with pytest.raises(ValueError):
        token_store.located(shard)


def test_forgetful_encoder_is_the_tokenizer(monkeypatch):
    monkeypatch.setattr(encode, "MAX_UNITS", 300)
    monkeypatch.setattr(encode, "TOGETHER", 7)
    plain = Tokenizer.from_file(BPE)
    own = encode.CachedEncoder(BPE, added=True)
    rng = random.Random(11)
    for _ in range(30):
        texts = [words(rng, rng.randrange(80), 60 + 900 * rng.randrange(2)).replace("w5", rng.choice(["\n", "<|endoftext|>", "it's ", "é"])) for _ in range(6)]
        ids, bounds = own.encode(texts, 7)
        for text, a, b in zip(texts, bounds, bounds[1:], strict=False):
            assert ids[a:b].tolist() == [*plain.encode(text, add_special_tokens=False).ids, 7]
    assert len(own.starts) < 1_500
