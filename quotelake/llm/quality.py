"""Quality by compression: which of two dictionaries shortens a text more.

zstandard dictionaries are built from good and from bad labelled text. A text
is compressed block by block with each, and the difference of the sizes, over
the text's length, tells which kind it is like; text that shrinks very much
with either is repetitive, so the better ratio counts too. A logistic
function, fitted on labelled rows that built no dictionary, turns both into a
score.

Fitted on a bounded sample: at most about ``PER_CLASS`` rows of each label,
drawn by a hash of doc_id, a stretch of ``SAMPLE_BYTES`` characters of each at a
hashed place; everything is scored on its whole text. Labels reach only rows of other folds than the held-out one.

Defined results: null text is empty; an empty text has the share of good labels
as score, and so has every text where a label is missing altogether; several
labels of a doc_id count by their mean (good from one half on); a null doc_id
is never learned from and not held out; repeated rows are scored each; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import regroup, texts_of
from quotelake.llm.language_id import remainder, stretch

PER_CLASS = 3_000
SAMPLE_BYTES = 8_192
DICTIONARY_BYTES = 48 << 10
# Length of the stretches that the dictionary trainer picks.
SEGMENT = 64
BLOCK = 2_048
LEVEL = 3
BATCH_BYTES = 8 << 20
THRESHOLD = 0.7


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    weights: np.ndarray
    prior: float

    def __post_init__(self) -> None:
        self._compressors: list[zstandard.ZstdCompressor] = []

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_compressors"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._compressors = []

    def features(self, texts: Sequence[bytes]) -> np.ndarray:
        """Of texts that are not empty: difference of ratios, better ratio, and their bends."""
        if not self._compressors:
            for content in (self.good, self.bad):
                dictionary = zstandard.ZstdCompressionDict(content)
                dictionary.precompute_compress(level=LEVEL)
                self._compressors.append(
                    zstandard.ZstdCompressor(
                        level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False
                    )
                )
        good, bad = (c.compress for c in self._compressors)
        rows = []
        for text in texts:
            g = b = 0
            for at in range(0, len(text), BLOCK):
                block = text[at : at + BLOCK]
                g += len(good(block))
                b += len(bad(block))
            n = len(text)
            rows.append(((g - b) / n, min(g, b) / n, 1 / np.sqrt(n)))
        diff, best, short = np.array(rows, np.float64).reshape(-1, 3).T
        bend = diff * np.abs(diff) * 100
        return np.stack([np.ones_like(diff), diff * 10, bend, best, best * best, short, short * diff * 10], 1)

    def scores(self, texts: Sequence[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        full = [i for i, t in enumerate(texts) if t]
        if full and len(self.weights):
            out[full] = 1 / (1 + np.exp(-np.clip(self.features([texts[i] for i in full]) @ self.weights, -30, 30)))
        return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = 1e-3 * np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> CompressionModel:
    outside = remainder(folds) != held
    known = labels.where(outside & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    counts = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = counts.get(True, 0) / max(1, sum(counts.values()))
    empty = CompressionModel(b"", b"", np.zeros(0), prior)
    if len(counts) < 2:
        return empty
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("quality")), 11) / F.lit(float(1 << 53))
    shares = {good: min(1.0, PER_CLASS / n) for good, n in counts.items()}
    drawn = known.where(draw < F.when(F.col("good"), shares[True]).otherwise(shares[False]))
    # The draw depends on doc_id alone: texts that no label could choose stay out of the join.
    texts = docs.where(outside & (draw < max(shares.values())) & (F.octet_length("text") > 0))
    texts = texts.select("doc_id", stretch("text", SAMPLE_BYTES).alias("text"))
    found = sorted(texts.join(drawn, "doc_id").collect(), key=lambda r: (r["doc_id"], r["text"]))
    rows = [(r["text"].encode(), r["good"]) for r in found]
    build, fit = rows[::2], rows[1::2]
    kinds = [[t for t, good in build if good is kind] for kind in (True, False)]
    if not all(kinds) or len({good for _, good in fit}) < 2:
        return empty
    size = min(DICTIONARY_BYTES, *(sum(map(len, k)) for k in kinds))
    model = CompressionModel(*(_dictionary(k, size) for k in kinds), np.zeros(0), prior)
    x = model.features([t for t, _ in fit])
    y = np.array([good for _, good in fit], float)
    # Rows were drawn by class; weigh them back by shifting the constant.
    model.weights = _logistic(x, y)
    drawn_odds = y.mean() / (1 - y.mean())
    model.weights[0] += np.log(prior / (1 - prior)) - np.log(drawn_odds)
    return model


def _dictionary(texts: Sequence[bytes], size: int) -> bytes:
    """What zstandard's trainer finds most useful in the sampled texts; small samples are content as they are."""
    if sum(map(len, texts)) <= 10 * size:
        each = -(-size // len(texts))
        return b"".join(t[:each] for t in texts)
    return zstandard.train_dictionary(size, list(texts), k=SEGMENT, d=8).as_bytes()


SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"


def _score(model: CompressionModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", BATCH_BYTES):
            scores = model.scores(texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(scores),
                    pa.array((scores >= THRESHOLD).astype(np.int32)),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return score


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = fit_quality(docs, labels, folds, held)
    held_out = F.coalesce(remainder(folds) == held, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held_out, "text").mapInArrow(_score(model), SCHEMA)
