"""Joins, models and the pipeline, against plain Python and held-out rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from quotelake.llm import language_id, ngram_join, quality
from quotelake.llm.components import components
from quotelake.llm.common import table
from quotelake.llm.queries import ORACLE, QUERIES
from tests.conftest import SF, rows
from tests.llm.conftest import edge_rows
from tests.llm.test_text_operators import lowered
from tests.test_queries import canonical, duck  # noqa: F401


def shingles(text, size):
    words = lowered(text).encode().split()
    if not words:
        return frozenset()
    width = min(size, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_groups(data, size, percent):
    sets = [shingles(t, size) for _, t in data]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for token in s:
            where[token].append(i)
    pairs = {(i, j) for held in where.values() for k, j in enumerate(held) for i in held[:k]}
    for i, j in pairs:
        common = len(sets[i] & sets[j])
        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(data):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return Counter(
        (doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(data)
    )


def test_similar_documents(docs, no_docs):
    data = [(r[0], r[1]) for r in edge_rows()]
    found = Counter(tuple(r) for r in ngram_join.similar_documents(docs).collect())
    assert found == brute_groups(data, 4, 85)
    assert ngram_join.similar_documents(no_docs).collect() == []


@pytest.mark.parametrize(("frequent", "percent"), [(64, 85), (2, 85), (2, 60)])
def test_near_copies_of_many(spark, monkeypatch, frequent, percent):
    """A large family of near copies at every distance, with token pairs in use."""
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in rng.integers(0, 500, 150)]
    data = []
    for i in range(150):
        words = list(base)
        for at in rng.integers(0, len(words), i % 14):
            words[at] = f"new{i}at{at}"
        data.append((i, " ".join(words[: 150 - i % 5])))
    frame = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
    found = Counter(tuple(r) for r in ngram_join.similar_documents(frame, 4, percent).collect())
    assert found == brute_groups(data, 4, percent)


def test_queries_join_matches_brute_force(spark):
    data = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    found = Counter(tuple(r) for r in QUERIES["op2_ngram_join"](spark, SF).collect())
    assert found == brute_groups(data, 4, 85)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (200, 200)]
    found = {tuple(r) for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {(i, 0) for i in range(41)} | {(100, 100), (101, 100), (103, 100)} <= found
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def folded(doc, by):
    return zlib.crc32(str(doc).encode()) % by


def test_language_accuracy_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    found = rows(QUERIES["op10_language_id"](spark, sf))
    assert len(found) == len(langs) and all(r["held_out"] == (folded(r["doc_id"], 5) == 0) for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(langs[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_edges(docs, no_docs):
    found = language_id.predict_languages(docs).collect()
    assert len(found) == len(edge_rows())
    unknown = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert {0, 1, 2} <= unknown and 9 not in unknown
    assert {r["lang_pred"] for r in found} <= {"en", "de", "und"}
    assert language_id.predict_languages(no_docs).collect() == []
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["lang_pred"] != "und" for r in found)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = pq.read_table(f"{sf}/labels.parquet").to_pandas().set_index("doc_id").quality
    found = rows(QUERIES["op6_quality"](spark, sf))
    assert all(r["held_out"] == (folded(r["doc_id"], 4) == 2) for r in found)
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in found)
    held = [(r["score"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels.index]
    assert sum((s >= 0.7) == (q == 1) for s, q in held) >= 0.93 * len(held)


def test_quality_edges(docs, no_docs, spark):
    marks = [(9, 1, 0), (13, 0, 0), (None, 1, 1), (14, None, 0), (14, 1, 0), (14, 1, 0), (12, 0, 1), (16, 0, 0), (19, 1, 0), (99, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    for frame in (labels, labels.where("quality = 1"), labels.limit(0)):
        found = quality.score_quality(docs, frame).collect()
        assert len(found) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in found)
    assert quality.score_quality(no_docs, labels).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, duck, name):  # noqa: F811
    df = QUERIES[name](spark, SF)
    expected = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(expected.columns, expected.fetchall())


def stages(spark, docs, sf_dir, path):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = out[name] = spark.read.parquet(f"{path}/{name}")
    return out


def test_pipeline_stages(spark, docs, tmp_path):
    found = stages(spark, docs, SF, str(tmp_path))
    for name in list(found)[:-1]:
        assert found[name].columns == docs.columns
    texts = {n: Counter((r["doc_id"], r["text"]) for r in f.collect()) for n, f in list(found.items())[:-1]}
    assert all(t and any(c.isalpha() for c in t) for _, t in texts["language_id"])
    once = texts["exact_copies"]
    assert set(once.values()) == {1} and len({lowered(t) for _, t in once}) == len(once)
    assert {lowered(t) for _, t in once} == {lowered(t) for _, t in texts["language_id"]}
    groups = brute_groups(list(once), 5, 80)
    assert {d for d, _ in texts["near_copies"]} == {d for d, _, c in groups if d == c}
    packed = Counter(r["doc_id"] for r in found["packing"].collect() if r["start"] == 0)
    assert packed == Counter(d for d, _ in texts["decontamination"].elements())


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
