"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text is a bag of three kinds of terms, each log-scaled, weighted by inverse
document frequency and brought to length 1: hashed byte 3-grams (case and
punctuation kept), 3-grams of byte classes (upper, lower, digit, blank, line
end, mark, non-ASCII; alike in every language), and words that repeat or do not
repeat the word before. A bounded sample of labelled rows
spans the latent space: the leading singular vectors of its term matrix,
computed in numpy on the driver. The sample's latent vectors and labels are
broadcast (their size is ``sample_rows`` x ``rank``); every document is
projected in blocks, exact cosines with all sample vectors come from one
matrix product per block, and the ``k`` nearest vote with their similarity.

The sample: about ``sample_rows`` labelled rows, chosen by a hash of the id.
Conflicting labels of one id count as their mean, from 0.5 on as 1.

Defined results: texts without a word, and texts orthogonal to the sample,
get the sample's share of label 1; without labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import fold_of, slices, string_bytes
from flowscope.llm.textnum import NOT_SPACE, span_hashes, word_spans

SAMPLE_ROWS = 3000
BUCKETS = 2048
RANK = 96
K = 15
BLOCK = 512
POWER = 8  # a vote weighs its cosine to this power


CLASSES = 7
CLASS = np.full(256, 5, np.uint8)
CLASS[0x41:0x5B], CLASS[0x61:0x7B], CLASS[0x30:0x3A], CLASS[0x80:] = 0, 1, 2, 6
CLASS[[0x20, 0x09]], CLASS[[0x0A, 0x0D]] = 3, 4
# columns of the term matrix: byte 3-grams, class 3-grams, (repeated, fresh) words
PARTS = np.cumsum([0, BUCKETS, CLASSES ** 3, 2])


def term_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x terms."""
    rows = len(offsets) - 1
    out = np.zeros((rows, PARTS[-1]), np.float32)
    if not len(raw):
        return out
    row = np.repeat(np.arange(rows), np.diff(offsets))
    if len(raw) >= 3:
        d, c = raw.astype(np.uint32), CLASS[raw].astype(np.int64)
        g = (d[:-2] << 16) | (d[1:-1] << 8) | d[2:]
        bucket = (g * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        shape = (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]
        whole = row[:-2] == row[2:]
        for part, term, size in ((0, bucket, BUCKETS), (1, shape, CLASSES ** 3)):
            flat = np.bincount(row[:-2][whole] * size + term[whole], minlength=rows * size)
            out[:, PARTS[part]: PARTS[part + 1]] = flat.reshape(rows, size)
    starts, ends, first = word_spans(raw, offsets, NOT_SPACE)
    h = span_hashes(raw, starts, ends)
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[first[:-1][first[:-1] < len(h)]] = False
    repeats = np.concatenate([[0], np.cumsum(again)])
    out[:, PARTS[2]] = repeats[first[1:]] - repeats[first[:-1]]
    out[:, PARTS[2] + 1] = np.diff(first) - out[:, PARTS[2]]
    return out


class Neighbours:
    """The latent space and the labelled vectors in it."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray):
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.labels = labels.astype(np.float32)
        n = max(1, len(counts))
        self.idf = np.log((1 + n) / (1 + (counts > 0).sum(0))).astype(np.float32) + np.float32(1)
        x = self._weigh(counts)
        gram = x.T @ x if x.shape[0] >= x.shape[1] else x @ x.T
        values, vectors = np.linalg.eigh(gram.astype(np.float64))
        keep = np.argsort(-values)[:RANK]
        keep = keep[values[keep] > 1e-9 * max(1e-9, values.max(initial=0))]
        basis = vectors[:, keep] if x.shape[0] >= x.shape[1] else (x.T @ vectors[:, keep]) / np.sqrt(values[keep])
        self.basis = basis.astype(np.float32)
        self.vectors = self._unit(x @ self.basis)

    def _weigh(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        x[:, PARTS[2]:] = counts[:, PARTS[2]:]  # two columns: their ratio counts, not their rarity
        return np.concatenate([self._unit(x[:, a:b]) for a, b in zip(PARTS[:-1], PARTS[1:])], axis=1)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        near = self._unit(self._weigh(counts) @ self.basis) @ self.vectors.T
        k = min(K, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < near.shape[1] else np.tile(np.arange(k), (len(near), 1))
        weight = np.maximum(np.take_along_axis(near, top, 1), 0) ** POWER
        total = weight.sum(1)
        vote = (weight * self.labels[top]).sum(1)
        return np.where(total > 0, np.divide(vote, total, out=np.zeros_like(vote), where=total > 0), self.prior)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = string_bytes(batch.column(1))
        for a, b in slices(offsets):
            c = term_counts(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a),
                                              pa.array([r.tobytes() for r in c], pa.binary())], ["label", "counts"])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Neighbours:
    """Fit on rows of docs (doc_id, text) that labels (doc_id, label) marks."""
    marked = (labels.where("doc_id is not null and label is not null").groupBy("doc_id")
              .agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    n = marked.count()
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = marked.where(pick < min(1.0, sample_rows / max(1, n)))  # about sample_rows rows: small enough to broadcast
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
            .select("label", "text").mapInArrow(_count_task, "label int, counts binary").toPandas())
    counts = (np.frombuffer(b"".join(rows["counts"]), np.float32).reshape(-1, PARTS[-1]) if len(rows)
              else np.zeros((0, PARTS[-1]), np.float32))
    return Neighbours(counts, rows["label"].to_numpy(np.int64))


def predict(docs: DataFrame, model: Neighbours) -> DataFrame:
    """doc_id, score per row; only the text is read."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_bytes(batch.column(1))
            scores = []
            for a, b in slices(offsets):
                for c in range(a, b, BLOCK):
                    e = min(b, c + BLOCK)
                    scores.append(held.value.score(term_counts(raw[offsets[c]: offsets[e]], offsets[c: e + 1] - offsets[c])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                np.clip(np.concatenate(scores), 0, 1).astype(np.float64) if scores else np.empty(0))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: labels learned from folds 0 and 2 of 3."""
    marks = labels.where(fold_of("doc_id", 3) != 1).select("doc_id", F.col("quality").alias("label"))
    out = predict(docs, train(docs, marks))
    return out.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
