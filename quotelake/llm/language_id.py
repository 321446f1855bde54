"""Language identification by a convolutional network over bytes.

Filters of several widths slide over a window of bytes (A-Z lower-cased); the
greatest response of each filter in the window goes through a softmax layer.
A filter's first layer is a table per offset (byte -> weights), so a
convolution is a few table look-ups, and of a window only the bytes at the
greatest response get a gradient. Trained in numpy with Adam on a bounded
sample: about ``PER_LANG`` documents of each language, and about ``SAMPLE_ROWS``
of all (then equally many of each, ``LEAST_ROWS`` at least), drawn by a hash of
doc_id; of each ``WINDOWS`` windows from a stretch at a hashed place. Every
language of the labelled rows is learned. The model (under 100 KB for 400
languages) goes to the tasks in the function's closure.

A whole text is cut into windows that overlap by the widest filter, and the
mean of their log-probabilities decides.

Defined results: ``und`` with score 0 where the text is null or has no letter,
or where no language could be learned (``keep_identified`` then keeps texts
that have letters); a null doc_id is never learned from and
not held out; repeated rows are predicted each; an empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import LOWER_ASCII, claim, nothing, regroup, texts_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
PER_LANG = 700
LEAST_ROWS = 20
SAMPLE_ROWS = 16_000
SAMPLE_BYTES = 16_384
WINDOWS = 4
EPOCHS = 12
BATCH = 64
BATCH_BYTES = 4 << 20
LETTER = regex.compile(r"\p{L}")


class ByteConvNet:
    def __init__(self, labels: list[str], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.tables = [
            [rng.normal(0, 0.3, (256, FILTERS)).astype(np.float32) for _ in range(w)] for w in WIDTHS
        ]
        hidden = FILTERS * len(WIDTHS)
        self.weights = rng.normal(0, 0.1, (hidden, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Greatest responses (rectified) and where they are, of (n, WINDOW) bytes."""
        out, places = [], []
        for width, tables in zip(WIDTHS, self.tables, strict=True):
            length = windows.shape[1] - width + 1
            response = tables[0][windows[:, :length]]
            for offset in range(1, width):
                response += tables[offset][windows[:, offset : offset + length]]
            at = response.argmax(1)
            places.append(at)
            out.append(np.take_along_axis(response, at[:, None, :], 1)[:, 0])
        return np.maximum(np.concatenate(out, 1), 0), places

    def greatest(self, windows: np.ndarray) -> np.ndarray:
        """As ``pooled``, without the places."""
        out = []
        for width, tables in zip(WIDTHS, self.tables, strict=True):
            length = windows.shape[1] - width + 1
            response = tables[0][windows[:, :length]]
            for offset in range(1, width):
                response += tables[offset][windows[:, offset : offset + length]]
            out.append(response.max(1))
        return np.maximum(np.concatenate(out, 1), 0)

    def log_probabilities(self, hidden: np.ndarray) -> np.ndarray:
        scores = hidden @ self.weights + self.bias
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))

    def fit(self, windows: np.ndarray, labels: np.ndarray, weight: np.ndarray, seed: int = 7) -> ByteConvNet:
        rng = np.random.default_rng(seed)
        slots = [*[t for tables in self.tables for t in tables], self.weights, self.bias]
        first, second = [np.zeros_like(s) for s in slots], [np.zeros_like(s) for s in slots]
        step = 0
        for epoch in range(EPOCHS):
            rate = 0.01 * (1 - epoch / EPOCHS) + 0.001
            order = rng.permutation(len(windows))
            for begin in range(0, len(order), BATCH):
                pick = order[begin : begin + BATCH]
                x, n = windows[pick], len(pick)
                hidden, places = self.pooled(x)
                error = np.exp(self.log_probabilities(hidden))
                error[np.arange(n), labels[pick]] -= 1
                error *= (weight[pick] / n)[:, None]
                back = (error @ self.weights.T) * (hidden > 0)
                grads = []
                column = np.broadcast_to(np.arange(FILTERS), (n, FILTERS))
                for k, (width, tables) in enumerate(zip(WIDTHS, self.tables, strict=True)):
                    part = back[:, k * FILTERS : (k + 1) * FILTERS]
                    for offset in range(width):
                        grad = np.zeros_like(tables[offset])
                        byte = np.take_along_axis(x, places[k] + offset, 1)
                        np.add.at(grad, (byte, column), part)
                        grads.append(grad)
                grads += [hidden.T @ error, error.sum(0)]
                step += 1
                for slot, grad, m, v in zip(slots, grads, first, second, strict=True):
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad * grad - v)
                    slot -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def predict(self, texts: list[bytes]) -> list[tuple[str, float]]:
        """Label and probability of each whole text."""
        step = WINDOW - max(WIDTHS) + 1
        # Short texts are padded to a window, long ones run over as many as they fill.
        counts = [max(1, -(-(len(t) - max(WIDTHS) + 1) // step)) for t in texts]
        flat = b"".join(
            t.translate(LOWER_ASCII).ljust((c - 1) * step + WINDOW, b"\0") for t, c in zip(texts, counts, strict=True)
        )
        view = np.frombuffer(flat, np.uint8)
        starts = np.concatenate([[0], np.cumsum([(c - 1) * step + WINDOW for c in counts])])[:-1]
        first = np.repeat(starts, counts)
        within = np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = first + within * step
        windows = np.lib.stride_tricks.sliding_window_view(view, WINDOW)
        found = [
            self.log_probabilities(self.greatest(windows[first[i : i + BATCH]])) for i in range(0, len(first), BATCH)
        ]
        means = np.add.reduceat(np.concatenate(found), np.cumsum(counts) - counts, axis=0) / np.array(counts)[:, None]
        probabilities = np.exp(means)
        probabilities /= probabilities.sum(1, keepdims=True)
        best = probabilities.argmax(1)
        return [(self.labels[b], float(p[b])) for b, p in zip(best.tolist(), probabilities, strict=True)]


def remainder(by: int) -> Column:
    """crc32 of doc_id as text, modulo ``by``."""
    return F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(by))


def stretch(text: str, size: int) -> Column:
    """So many characters of a text, from a place drawn by a hash of doc_id and the text's length."""
    room = F.greatest(F.lit(1), F.char_length(text) - size + 1)
    at = F.pmod(F.xxhash64("doc_id", F.char_length(text), F.lit("stretch")), room)
    return F.substring(text, (at + 1).cast("int"), F.lit(size))


def fit_languages(docs: DataFrame, folds: int = 5) -> ByteConvNet | None:
    """Learn from rows of other folds than 0; None where there is no language."""
    known = docs.where((remainder(folds) != 0) & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    counts = known.groupBy("lang").count().collect()
    if not counts:
        return None
    quota = min(PER_LANG, max(LEAST_ROWS, SAMPLE_ROWS // len(counts)))
    labels = sorted(r["lang"] for r in counts)
    # A row's draw is even in 0..1; each language keeps the share that gives its quota.
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("language")), 11) / F.lit(float(1 << 53))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, quota / r["count"]))])
    drawn = known.where(draw < share[F.col("lang")]).select(
        "doc_id", "lang", stretch("text", SAMPLE_BYTES).alias("text")
    )
    rows = sorted(drawn.collect(), key=lambda r: (r["doc_id"], r["text"]))
    if not rows:
        return None
    rng = np.random.default_rng(11)
    windows, targets = [], []
    for row in rows:
        text = row["text"].encode().translate(LOWER_ASCII)
        for k in range(WINDOWS):
            at = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
            # One window in four is short, as some texts are.
            size = WINDOW if k else int(rng.integers(12, WINDOW))
            windows.append(np.frombuffer(text[at : at + size].ljust(WINDOW, b"\0"), np.uint8))
            targets.append(labels.index(row["lang"]))
    targets = np.array(targets)
    return ByteConvNet(labels).fit(np.stack(windows), targets, np.ones(len(targets), np.float32))


SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"


def _labels(model: ByteConvNet | None, texts: list[bytes]) -> list[tuple[str, float]]:
    claim("language_id", nothing)
    worded = [i for i, t in enumerate(texts) if LETTER.search(t.decode())]
    out = [("und", 0.0)] * len(texts)
    if worded and model is not None:
        for i, found in zip(worded, model.predict([texts[i] for i in worded]), strict=True):
            out[i] = found
    return out


def _predict(model: ByteConvNet | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", BATCH_BYTES):
            out = _labels(model, texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), batch.column("held_out"),
                    pa.array([x for x, _ in out], pa.string()), pa.array([s for _, s in out], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return predict


def predict_languages(docs: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    model = fit_languages(docs, folds)
    held_out = F.coalesce(remainder(folds) == 0, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held_out, "text").mapInArrow(_predict(model), SCHEMA)


def keep_identified(docs: DataFrame, folds: int = 5) -> DataFrame:
    """The rows, all columns, whose language is not ``und``; of texts with letters none goes where nothing was learned."""
    model = fit_languages(docs, folds)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", BATCH_BYTES):
            texts = texts_of(batch.column("text"))
            if model is None:
                stays = [LETTER.search(t.decode()) is not None for t in texts]
            else:
                stays = [label != "und" for label, _ in _labels(model, texts)]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
