"""Language identification with language-bitmask n-gram filters.

Training collects the byte 4-grams of lower-cased letters (everything else is
a space) per language, keeps those that at least ``min_share`` of the
language's training texts contain (and two of them, unless there are fewer than
``FEW_ROWS``: one training row is enough to be learned from), and inserts them into Bloom filters stored
bit-sliced: one table of slots, each a mask with one bit per language, so one
lookup returns every language that contains an n-gram. A text is scored by
popcount: per language the number of its n-grams found, corrected for the
expected false positives of that language's filter (its fill to the power of
the number of hash functions). The highest corrected count decides; its share
of all corrected counts is the score.

The training texts are a bounded sample: about ``sample_rows`` rows per
language (all rows of a smaller language), chosen by a hash of the id.

Defined results: ``und`` with score 0 for null texts and texts without a
letter; a text none of whose n-grams is known gets the language with most
training rows and score 0; without training rows everything is ``und``; more than
``MAX_LANGUAGES`` languages are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import fold_of, map_arrow, slices, string_bytes

U = np.uint64
SAMPLE_ROWS = 3000
MIN_SHARE = 0.01
FEW_ROWS = 10
SLOTS = 1 << 20
HASHES = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77))
MAX_LANGUAGES = 4096

FOLD = np.full(256, 0x20, np.uint8)
FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLD[0x80:] = np.arange(0x80, 0x100)


def padded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with a space before every row and three after the last; row starts."""
    rows = len(offsets) - 1
    data = np.full(len(raw) + rows + 3, 0x20, np.uint8)
    at = np.arange(len(raw)) + np.repeat(np.arange(1, rows + 1), np.diff(offsets))
    data[at] = FOLD[raw]
    return data, offsets + np.arange(rows + 1)


def four_grams(data: np.ndarray) -> np.ndarray:
    d = data.astype(np.uint32)
    return (d[:-3] << 24) | (d[1:-2] << 16) | (d[2:-1] << 8) | d[3:]


def _train_task(languages: list[str]):
    code = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_bytes(batch.column(1))
            lang = np.array([code[x] for x in batch.column(0).to_pylist()], np.int64)
            for a, b in slices(offsets):
                data, first = padded(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                g = four_grams(data)
                row = np.repeat(np.arange(b - a), np.diff(first))
                seen = np.unique((row.astype(U) << U(32)) | g[: len(row)])  # each n-gram once per text
                own = lang[a:b][(seen >> U(32)).astype(np.int64)].astype(U) << U(32) | seen & U(0xFFFFFFFF)
                key, n = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((key >> U(32)).astype(np.int32)),
                                                  pa.array((key & U(0xFFFFFFFF)).astype(np.int64)), pa.array(n)],
                                                 ["lang", "gram", "n"])
    return run


def slots_of(g: np.ndarray) -> list[np.ndarray]:
    g = g.astype(np.uint32)
    return [((g * m) ^ ((g * m) >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(12) for m in HASHES]


class Filters:
    """Bit-sliced Bloom filters: slot -> mask of languages (words of 64)."""

    def __init__(self, languages: list[str], default: int):
        self.languages, self.default = languages, default
        self.masks = np.zeros((max(1, -(-len(languages) // 64)), SLOTS), np.uint64)

    def insert(self, lang: np.ndarray, gram: np.ndarray):
        bit = U(1) << (lang % 64).astype(U)
        for slot in slots_of(gram):
            np.bitwise_or.at(self.masks, (lang // 64, slot), bit)

    def false_rates(self) -> np.ndarray:
        return np.array([np.count_nonzero(self.masks[i // 64] >> U(i % 64) & U(1)) / SLOTS
                         for i in range(len(self.languages))]) ** len(HASHES)

    def corrected(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows x languages: n-grams found, less the expected false positives."""
        data, first = padded(raw, offsets)
        g = four_grams(data)
        a, b = slots_of(g)
        letters = (g >> np.uint32(8)) != np.uint32(0x202020)  # runs of spaces say nothing
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        ends = first[1:].clip(max=len(g))
        total = np.concatenate([[0], np.cumsum(letters)])
        n = total[ends] - total[first[:-1]]
        for w in range(len(self.masks)):
            mask = self.masks[w][a] & self.masks[w][b]
            mask[~letters] = U(0)
            for i in range(w * 64, min(len(self.languages), w * 64 + 64)):
                found = np.concatenate([[0], np.cumsum((mask >> U(i % 64)).astype(np.uint8) & 1, dtype=np.int64)])
                out[:, i] = found[ends] - found[first[:-1]]
        rate = self.rates
        return np.maximum(0, (out - n[:, None] * rate) / (1 - np.minimum(rate, 0.999)))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, min_share: float = MIN_SHARE) -> Filters:
    """Fit filters on rows of (doc_id, text, lang) with a language."""
    known = docs.where("lang is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(counts)
    filters = Filters(languages, max(range(len(languages)), key=lambda i: (counts[languages[i]], -i), default=0))
    if languages:
        share = F.create_map(*(F.lit(v) for x in languages for v in (x, min(1.0, sample_rows / counts[x]))))
        pick = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
        sample = known.where(pick < share[F.col("lang")]).select("lang", F.coalesce("text", F.lit("")).alias("text"))
        grams = (map_arrow(sample, _train_task(languages), "lang int, gram long, n long")
                 .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
        least = F.create_map(*(F.lit(v) for i, x in enumerate(languages)
                               for v in (i, max(1.0 if counts[x] < FEW_ROWS else 2.0, min_share * min(sample_rows, counts[x])))))
        # bounded by the sample: an n-gram kept occurs in a fixed share of a language's sampled texts
        kept = grams.where(F.col("n") >= least[F.col("lang")]).toPandas()
        filters.insert(kept["lang"].to_numpy(np.int64), kept["gram"].to_numpy(np.int64))
    filters.rates = filters.false_rates()
    return filters


def predict(docs: DataFrame, filters: Filters, keep: list[str] = ()) -> DataFrame:
    """doc_id, the ``keep`` columns, lang_pred, score per row; only the text is read."""
    held = docs.sparkSession.sparkContext.broadcast(filters)
    source = docs.select("doc_id", *keep, F.coalesce("text", F.lit("")).alias("text"),
                         F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    n_kept = 1 + len(keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:n_kept]]
                       + ["lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = held.value
        names = np.array([*f.languages, "und"], object)
        for batch in batches:
            raw, offsets = string_bytes(batch.column(n_kept))
            letter = np.array(batch.column(n_kept + 1).to_pylist(), bool)
            for a, b in slices(offsets):
                if f.languages:
                    c = f.corrected(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                    best, total = c.argmax(1), c.sum(1)
                    score = np.divide(c.max(1), total, out=np.zeros(b - a), where=total > 0)
                    best = np.where(total > 0, best, f.default)
                else:
                    best, score = np.full(b - a, 0), np.zeros(b - a)
                unknown = ~letter[a:b] | (len(f.languages) == 0)
                best = np.where(unknown, len(f.languages), best)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(n_kept)), pa.array(names[best], pa.string()),
                     pa.array(np.where(unknown, 0.0, score))], [*batch.schema.names[:n_kept], "lang_pred", "score"])

    return map_arrow(source, run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows of folds 0 and 2 of 3."""
    fold = docs.select("doc_id", "text", "lang", fold_of("doc_id", 3).alias("fold"))
    filters = train(fold.where("fold <> 1").select("doc_id", "text", "lang"))
    out = predict(docs.select("doc_id", "text"), filters)
    return out.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
