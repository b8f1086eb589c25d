"""Log-bilinear language model trained with noise-contrastive estimation.

**Counting.** Scan tasks hash the tokens of a block of documents and send each
owner of the hash space one Golomb-coded message: the block's distinct tokens
and their training counts. Owners add them up, answer every message with the
corpus counts, and report totals and their most frequent tokens. So the whole
vocabulary is counted over all training texts, but never in one place.

**Model.** The most frequent tokens are classes of their own; all others fall
into 128 shared classes by their last letters and whether a mark follows. The
class of a token given the classes v1, v2 of the two tokens before it (a start
class before the first token) has

    score(w | v1, v2) = q_w . (r1_v1 + r2_v2) + b_w,

log-bilinear in the vectors. b starts at the unigram log-probabilities; q, r1
and r2 are trained in numpy by noise-contrastive estimation with unigram noise.
The training data are the (v1, v2, w) counts of all training texts, dealt over
``SHARDS`` tasks by a hash (there are at most classes**3 distinct ones, at any
corpus size); each task trains on its share from the same start, the driver
averages the ``SHARDS`` parameter sets, ``ROUNDS`` times.

**Words.** Every known token of a shared class has a vector of its own, however many
there are. The owners of the hash space cut their tokens of a shared class, in hash
order, into lists of at most ``WORDS``; a token w of a list, with p its smoothed
unigram in the list, has given the token before it (x, of class v1) the probability

    p_w exp(u_w . (r1_v1 + r2_v2 + e_x)) / (the same, summed over the list),

with u and e trained in the owner's task by the softmax over the list, on every
(x, v2, w) of all training texts; r1 and r2 stay as they are. Blocks send the owners
their (x, v2, w) by row and get the logarithms back, added up per row, so these
contexts and the vectors grow with the corpus, and none reach the driver. Which list
of its class a token is in depends on the unigram alone.

**Scoring.** Normalisers of all classes**2 contexts come from batched matrix
products, so token probabilities are normalised exactly. A token of the shared
class also pays for itself among those tokens: (c + 0.1) / (M + 0.1 (U + 1)), with
M occurrences and U distinct tokens in that class, times its probability in its list
by its unigram there (a list sums to one, so the product is normalised, too).

Defined results: a null text is empty and holds only the end token; repeated
rows are scored (and learned from) separately; without training texts every
probability is the smoothed uniform one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import fold_of, shuffle_partitions, slices, stage, string_bytes
from flowscope.llm.exchange import cut_by_owner, decode, encode
from flowscope.llm.textnum import LOWER, NOT_SPACE, span_hashes, word_spans

U = np.uint64
END = U(0x2545F4914F6CDD1D)  # the end token's hash
CLASSES = 512
SIZE = 16  # length of the vectors
NOISE = 8
BATCH = 4096
SHARDS = 32
ROUNDS = 2
BLOCK_WORDS = 2_000_000
OWNERS_PER_PARTITION = 2
SMOOTH = 0.1
SHARED = 128
WORDS = 32  # tokens of a list, at most
PASSES = 2
LIST_BATCH = 2048
MARK = np.zeros(256, bool)
MARK[[ord(c) for c in ".,;:!?"]] = True

_SENT = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("owner", pa.int32()), ("message", pa.binary()),
                   ("counts", pa.binary()), ("tokens", pa.binary()), ("ids", pa.binary()), ("flags", pa.binary()),
                   ("sizes", pa.binary())])
_SENT_SQL = ("kind string, block long, owner int, message binary, counts binary, tokens binary, ids binary, flags binary, "
             "sizes binary")


LEVEL = 6  # of zstd


def pack(values: np.ndarray) -> bytes:
    """An array as one compressed string: all first bytes, then all second bytes and so on."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + (pa.Codec("zstd", LEVEL).compress(planes, asbytes=True) if planes else b"")


def unpack(blob: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    if not size:
        return np.empty(0, dtype)
    planes = np.frombuffer(pa.decompress(blob[8:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def pack_rising(values: np.ndarray) -> bytes:
    """``pack`` for ascending integers."""
    return pack(np.diff(values.astype(np.uint64), prepend=U(0)))


def unpack_rising(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


def by_rank(times: np.ndarray) -> np.ndarray:
    """Positions of the tokens, the most frequent first."""
    return np.argsort(-times.astype(np.int64), kind="stable")


def token_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rows' tokens (words, then the end token) and their row offsets."""
    data = LOWER[raw]
    starts, ends, first = word_spans(data, offsets, NOT_SPACE)
    h = span_hashes(data, starts, ends)
    if len(h):
        marked = MARK[data[ends - 1]]
        last = np.maximum(starts, ends - 1 - marked)
        before = np.maximum(starts, last - 1)
        letters = (data[before].astype(np.uint32) * np.uint32(251) + data[last]) * np.uint32(0x9E3779B1) >> np.uint32(26)
        h = (h & ~U(SHARED - 1)) | (letters.astype(U) << U(1)) | marked.astype(U)
    return np.insert(h, first[1:], END), first + np.arange(len(first))


def _fill(schema: pa.Schema, count: int, **given) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [given[f.name] if f.name in given else pa.nulls(count, f.type) for f in schema], schema=schema)


def _send(owners: int):
    def flush(block, ids, held, pieces):
        h = np.concatenate([p[0] for p in pieces])
        sizes = np.concatenate([np.diff(p[1]) for p in pieces])
        first = np.concatenate([[0], np.cumsum(sizes)])
        distinct, local = np.unique(h, return_inverse=True)
        learn = np.repeat(~np.array(held, bool), sizes)
        counts = np.bincount(local[learn], minlength=len(distinct)).astype(np.uint32)
        # tokens by rank of their count in the block: small numbers pack well, and the counts tell the ranks
        times = np.bincount(local, minlength=len(distinct)).astype(np.uint32)
        rank = np.empty(len(distinct), np.uint32)
        rank[by_rank(times)] = np.arange(len(distinct), dtype=np.uint32)
        flags = np.array([h + 2 * (i is None) for h, i in zip(held, ids)], np.uint8)
        yield _fill(_SENT, 1, kind=pa.array(["block"]), block=pa.array([block], pa.int64()),
                    tokens=pa.array([_bundle((pack(rank[local]), pack(times)))], pa.binary()),
                    ids=pa.array([pack(np.array([i or 0 for i in ids], np.int64))], pa.binary()),
                    flags=pa.array([pack(flags)], pa.binary()), sizes=pa.array([pack(sizes.astype(np.uint32))], pa.binary()))
        parts = cut_by_owner(distinct, owners)
        m = len(parts)
        yield _fill(_SENT, m, kind=pa.array(["message"] * m), block=pa.array([block] * m, pa.int64()),
                    owner=pa.array([p[0] for p in parts], pa.int32()),
                    message=pa.array([encode(distinct[a:b]) for _, a, b in parts], pa.binary()),
                    counts=pa.array([pack(counts[a:b]) for _, a, b in parts], pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        ids, held, pieces, size = [], [], [], 0
        for batch in batches:
            raw, offsets = string_bytes(batch.column(2))
            doc_ids, held_out = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(offsets):
                pieces.append(token_hashes(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]))
                ids += doc_ids[a:b]
                held += held_out[a:b]
                size += len(pieces[-1][0])
                if size >= BLOCK_WORDS:
                    yield from flush(block, ids, held, pieces)
                    block, ids, held, pieces, size = block + 1, [], [], [], 0
        if ids:
            yield from flush(block, ids, held, pieces)

    return run


_COUNTED = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("owner", pa.int32()),
                      ("counts", pa.binary()), ("token", pa.int64()), ("n", pa.int64())])
_COUNTED_SQL = "kind string, block long, owner int, counts binary, token long, n long"


def _count(classes: int):
    def run(table: pa.Table) -> pa.Table:
        """An owner's work: corpus counts for every message, totals, most frequent tokens."""
        sets = [decode(m) for m in table["message"].to_pylist()]
        counts = [unpack(c, np.uint32) for c in table["counts"].to_pylist()]
        distinct, at = np.unique(np.concatenate(sets), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.uint64)
        ends = np.cumsum([len(s) for s in sets])
        n = len(sets)
        replies = _fill(_COUNTED, n, kind=pa.array(["reply"] * n), block=table["block"].combine_chunks(),
                        owner=table["owner"].combine_chunks(),
                        counts=pa.array([pack(total[at[e - len(s): e]]) for s, e in zip(sets, ends)], pa.binary()))
        top = np.lexsort((distinct, -total.astype(np.int64)))[: classes]
        top = top[total[top] > 0]
        tops = _fill(_COUNTED, len(top), kind=pa.array(["top"] * len(top)), token=pa.array(distinct[top].view(np.int64)),
                     n=pa.array(total[top].astype(np.int64)))
        shared = (distinct & U(SHARED - 1)).astype(np.int64)
        sums = _fill(_COUNTED, SHARED, kind=pa.array(["sum"] * SHARED), block=pa.array(np.arange(SHARED)),
                     token=pa.array(np.bincount(shared, total > 0, SHARED).astype(np.int64)),
                     n=pa.array(np.bincount(shared, total.astype(np.float64), SHARED).astype(np.int64)))
        return pa.Table.from_batches([replies, tops, sums])
    return run


class Vocabulary:
    """Totals and the frequent tokens: small, sent to every task."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, n: np.ndarray, v: np.ndarray):
        """Frequent tokens with their counts; occurrences and distinct tokens per shared class."""
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]
        self.n, self.v = int(n.sum()), int(v.sum())
        self.size = len(tokens)  # shared classes follow, then the start class
        shared = (self.tokens & U(SHARED - 1)).astype(np.int64)
        self.rest_n = n - np.bincount(shared, self.counts, SHARED).astype(np.int64)
        self.rest_v = v - np.bincount(shared, minlength=SHARED)

    def classes(self, h: np.ndarray) -> np.ndarray:
        shared = self.size + (h & U(SHARED - 1)).astype(np.int64)
        if not self.size:
            return shared
        at = np.searchsorted(self.tokens, h).clip(max=self.size - 1)
        return np.where(self.tokens[at] == h, at, shared)

    def low_classes(self, low: np.ndarray) -> np.ndarray:
        """``classes`` by the low 32 bits of the hashes."""
        shared = self.size + (low & np.uint32(SHARED - 1)).astype(np.int64)
        if not self.size:
            return shared
        order = np.argsort(self.tokens.astype(np.uint32))
        mine = self.tokens.astype(np.uint32)[order]
        at = np.searchsorted(mine, low).clip(max=self.size - 1)
        return np.where(mine[at] == low, order[at], shared)


_SCORED = pa.schema([("kind", pa.string()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("base_score", pa.float64()), ("rest_score", pa.float64()),
                     ("classes", pa.binary()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()),
                     ("block", pa.int64()), ("row", pa.int64()), ("items", pa.binary())])
_SCORED_SQL = ("kind string, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
               "rest_score double, classes binary, shard int, keys binary, counts binary, block long, row long, items binary")


def _bundle(blobs) -> bytes:
    return b"".join(len(b).to_bytes(8, "little") + b for b in blobs)


def _unbundle(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at: at + 8], "little")
        out.append(blob[at + 8: at + 8 + n])
        at += 8 + n
    return out


def contexts(classes: np.ndarray, first: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the two tokens before each token of rows classes[first[r]:first[r+1]]."""
    v1 = np.full(len(classes), start, np.int64)
    v2 = np.full(len(classes), start, np.int64)
    v1[1:] = classes[:-1]
    v2[2:] = classes[:-2]
    heads = first[:-1]
    v1[heads] = start
    v2[heads] = start
    v2[(heads + 1)[np.diff(first) > 1]] = start
    return v1, v2


def _block_scores(vocabulary):
    def run(sent: pa.Table, replies: pa.Table) -> pa.Table:
        """One block: counts by local token, per-document sums, class ids and context counts."""
        v = vocabulary.value
        replied = dict(zip(replies["owner"].to_pylist(), replies["counts"].to_pylist()))
        messages = sorted(((o, m) for k, o, m in zip(*(sent[c].to_pylist() for c in ("kind", "owner", "message"))) if k == "message"))
        owners, sets = [o for o, _ in messages], [decode(m) for _, m in messages]
        h = np.concatenate(sets)
        c = np.concatenate([unpack(replied[o], np.uint64) for o in owners]).astype(np.float64)
        own = sent.filter(pc.equal(sent["kind"], "block")).to_pylist()[0]
        flags, ids = unpack(own["flags"], np.uint8), unpack(own["ids"], np.int64)
        of_token = v.classes(h)
        base = np.log10((c + SMOOTH) / (v.n + SMOOTH * (v.v + 1)))
        inside = (h & U(SHARED - 1)).astype(np.int64)
        rest = np.where(of_token >= v.size, np.log10((c + SMOOTH) / (v.rest_n + SMOOTH * (v.rest_v + 1))[inside]), 0.0)
        held = (flags & 1).astype(bool)
        sizes = unpack(own["sizes"], np.uint32).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)])
        ranks, times = (unpack(x, np.uint32) for x in _unbundle(own["tokens"]))
        tokens = by_rank(times)[ranks]
        classes = of_token[tokens]
        n = len(sizes)
        v1, v2 = contexts(classes, first, v.size + SHARED)
        wide = v.size + SHARED + 1
        learn = np.repeat(~held, sizes)
        # the known words of shared classes, with the token before each and the class before that
        pos = np.flatnonzero((classes >= v.size) & (c[tokens] > 0))
        pos = pos[np.argsort(tokens[pos], kind="stable")]
        word, before = tokens[pos], contexts(tokens, first, len(h))[0][pos]
        block = own["block"]
        add = lambda x: np.add.reduceat(x[tokens], first[:-1])  # noqa: E731  every row has its end token
        out = [_fill(_SCORED, n, kind=pa.array(["doc"] * n), doc_id=pa.array(ids, mask=flags > 1),
                     held_out=pa.array(held), n_tokens=pa.array(sizes), n_known=pa.array(add((c > 0).astype(np.int64))),
                     base_score=pa.array(add(base)), rest_score=pa.array(add(rest)),
                     classes=pa.array([classes[a:b].astype(np.uint16).tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()),
                     block=pa.array([block] * n, pa.int64()), row=pa.array(np.arange(n)))]
        name = np.append(h.astype(np.uint32), np.uint32(0))[before]  # low bits, which hold the shared class
        near = (v2[pos] + (1 << 15) * ~learn[pos]).astype(np.uint16)
        row = np.repeat(np.arange(n, dtype=np.uint32), sizes)[pos]
        cuts = np.searchsorted(word, np.concatenate([[0], np.cumsum([len(o) for o in sets])]))
        for owner, a, b in zip(owners, cuts[:-1], cuts[1:]):
            if a < b:
                mine, n_mine = np.unique(word[a:b], return_counts=True)
                names, of_name = np.unique(name[a:b], return_inverse=True)
                told = (pack(c[mine].astype(np.uint64)), pack(n_mine.astype(np.uint32)))
                # rows rise within a word: the first one, then differences
                heads = np.r_[True, word[a + 1:b] != word[a:b - 1]]
                steps = np.where(heads, row[a:b], np.diff(row[a:b], prepend=np.uint32(0)))
                items = (pack_rising(names), pack(of_name.astype(np.uint32)), pack(steps), pack(near[a:b]))
                out.append(_fill(_SCORED, 1, kind=pa.array(["words"]), block=pa.array([block], pa.int64()), shard=pa.array([owner], pa.int32()),
                                 keys=pa.array([encode(h[mine])], pa.binary()), counts=pa.array([_bundle(told)], pa.binary()),
                                 items=pa.array([_bundle(items)], pa.binary())))
        key = ((v1 * wide + v2) * wide + classes)[learn]
        key, count = np.unique(key, return_counts=True)
        shard = (key * 0x9E3779B1 >> 16) % SHARDS
        for s in range(SHARDS):
            mine = shard == s
            if mine.any():
                out.append(_fill(_SCORED, 1, kind=pa.array(["contexts"]), shard=pa.array([s], pa.int32()),
                                 keys=pa.array([pack_rising(key[mine])], pa.binary()), block=pa.array([block], pa.int64()),
                                 counts=pa.array([pack(count[mine].astype(np.uint64))], pa.binary())))
        return pa.Table.from_batches(out)
    return run


def _add_rows(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``to[at] += rows`` with repeated positions added up."""
    order = np.argsort(at, kind="stable")
    own = at[order]
    head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    to[own[head]] += np.add.reduceat(rows[order], head)


class LogBilinear:
    """The parameters and what follows from them."""

    def __init__(self, unigram: np.ndarray):
        wide, rng = len(unigram) + 1, np.random.default_rng(7)
        self.noise = unigram
        self.q = (rng.standard_normal((wide - 1, SIZE)) * 0.1).astype(np.float32)
        self.r = (rng.standard_normal((2, wide, SIZE)) * 0.1).astype(np.float32)
        self.b = np.log(unigram).astype(np.float32)

    def arrays(self) -> list[np.ndarray]:
        return [self.q, self.r, self.b]

    def nce(self, v1, v2, w, weight, rng, rate=0.2):
        """One pass of noise-contrastive estimation over weighted contexts (Adagrad)."""
        sums = [np.full(x.shape, 1e-6, np.float32) for x in self.arrays()]
        # noise is drawn from a table of 2^20 entries, each class by its share
        cdf = np.cumsum(self.noise)
        table = np.searchsorted(cdf, (np.arange(1 << 20) + 0.5) / (1 << 20) * cdf[-1]).clip(max=len(cdf) - 1).astype(np.int32)
        log_noise = np.log(self.noise * NOISE).astype(np.float32)
        order = rng.permutation(len(w))
        for at in range(0, len(order), BATCH):
            i = order[at: at + BATCH]
            target = np.empty((len(i), 1 + NOISE), np.int32)
            target[:, 0] = w[i]
            target[:, 1:] = table[rng.integers(0, len(table), (len(i), NOISE), np.uint32)]
            h = self.r[0][v1[i]] + self.r[1][v2[i]]
            q = self.q[target]
            logit = np.einsum("nd,nkd->nk", h, q) + (self.b - log_noise)[target]
            # gradient of the log-likelihood of telling data (first column) from noise
            error = -1 / (1 + np.exp(-logit.clip(-30, 30)))
            error[:, 0] += 1
            error *= (weight[i] / weight[i].mean())[:, None]
            to_h = np.einsum("nk,nkd->nd", error, q)
            grads = [np.zeros_like(x) for x in self.arrays()]
            _add_rows(grads[0], target.ravel(), (error[:, :, None] * h[:, None, :]).reshape(-1, SIZE))
            _add_rows(grads[1][0], v1[i], to_h)
            _add_rows(grads[1][1], v2[i], to_h)
            grads[2] += np.bincount(target.ravel(), error.ravel(), len(grads[2])).astype(np.float32)
            for x, g, s in zip(self.arrays(), grads, sums):
                s += g * g
                x += rate * g / np.sqrt(s)

    def normalisers(self) -> np.ndarray:
        """log Z of every context (v1, v2), by one matrix product per v1."""
        wide = self.r.shape[1]
        out = np.empty((wide, wide), np.float32)
        for v1 in range(wide):
            s = (self.r[0][v1] + self.r[1]) @ self.q.T + self.b
            top = s.max(1)
            out[v1] = top + np.log(np.exp(s - top[:, None]).sum(1))
        return out


MERGE_ROWS = 1 << 22


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The contexts of a group's messages with their counts added up, a bounded number of messages at a time."""
    keys, counts, held = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], 0

    def add():
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        return [key], [np.bincount(at, np.concatenate(counts), len(key)).astype(np.uint64)]

    for k, c in zip(table["keys"].to_pylist(), table["counts"].to_pylist()):
        keys.append(unpack_rising(k))
        counts.append(unpack(c, np.uint64))
        held += len(keys[-1])
        if held >= MERGE_ROWS:
            keys, counts = add()
            held = 0
    keys, counts = add()
    return keys[0], counts[0]


def _merge_contexts(table: pa.Table) -> pa.Table:
    key, count = _merged(table)
    return pa.table({"shard": table["shard"][:1], "keys": pa.array([pack_rising(key)], pa.binary()), "counts": pa.array([pack(count)], pa.binary())})


def _merge(blocks: DataFrame) -> DataFrame:
    """(shard, keys, counts): the contexts of all blocks, counted once. Blocks are merged in groups
    first, so that no task takes the messages of all blocks."""
    parts = F.lit(max(1, math.isqrt(shuffle_partitions(blocks.sparkSession))))
    sent = blocks.where("kind = 'contexts'").select("shard", F.pmod(F.xxhash64("block"), parts).alias("part"), "keys", "counts")
    schema = "shard int, keys binary, counts binary"
    some = sent.groupBy("shard", "part").applyInArrow(_merge_contexts, schema)
    return stage(some.groupBy("shard").applyInArrow(_merge_contexts, schema), "lm-contexts")


def _train_shard(model):
    def run(table: pa.Table) -> pa.Table:
        key, counts = _merged(table)
        key, weight = key.astype(np.int64), counts.astype(np.float32)
        m = model.value
        wide = m.r.shape[1]
        # tame the heaviest contexts: a weight above the batch size would overshoot; it is split instead
        copies = np.ceil(weight / 64).astype(np.int64)
        key, weight = np.repeat(key, copies), np.repeat(weight / copies, copies)
        own = LogBilinear(m.noise)
        own.q, own.r, own.b = m.q.copy(), m.r.copy(), m.b.copy()
        own.nce(key // (wide * wide), key // wide % wide, key % wide, weight, np.random.default_rng(int(table["shard"][0].as_py())))
        blob = b"".join(x.astype(np.float32).tobytes() for x in own.arrays())
        return pa.table({"weight": pa.array([float(counts.sum())]), "model": pa.array([blob], pa.binary())})
    return run


def _train(context_counts: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    spark = context_counts.sparkSession
    n = np.concatenate([vocabulary.counts, vocabulary.rest_n]) + SMOOTH
    model = LogBilinear(n / n.sum())
    for _ in range(ROUNDS):
        held = spark.sparkContext.broadcast(model)
        shards = (context_counts.groupBy("shard").applyInArrow(_train_shard(held), "weight double, model binary")
                  .collect())  # SHARDS rows at most
        if not shards:
            break
        weight = np.array([r["weight"] for r in shards])
        mean = np.average([np.frombuffer(r["model"], np.float32) for r in shards], axis=0, weights=weight).astype(np.float32)
        fresh, at = LogBilinear(model.noise), 0
        for x in fresh.arrays():
            x[...] = mean[at: at + x.size].reshape(x.shape)
            at += x.size
        model = fresh
    return model


def fit_list(word, name, x, learn, p, seed: int) -> np.ndarray:
    """log(model / p) of each item of one list: word of the list, token before it, context vector, whether to learn from it."""
    u, e = np.zeros((len(p), SIZE), np.float32), np.zeros((name.max() + 1, SIZE), np.float32)
    sums = [np.full(a.shape, 1e-6, np.float32) for a in (u, e)]
    log_p, rng = np.log(p).astype(np.float32), np.random.default_rng(seed)
    learn = np.flatnonzero(learn)

    def model(i):
        h = x[i] + e[name[i]]
        s = h @ u.T + log_p
        s -= s.max(1, keepdims=True)
        return h, s

    for _ in range(PASSES):
        order = rng.permutation(learn)
        for a in range(0, len(order), LIST_BATCH):
            i = order[a: a + LIST_BATCH]
            h, s = model(i)
            np.exp(s, out=s)
            s /= -s.sum(1, keepdims=True)
            s[np.arange(len(i)), word[i]] += 1
            seen, of = np.unique(name[i], return_inverse=True)
            by = np.argsort(of, kind="stable")
            to_e = np.add.reduceat((s @ u)[by], np.searchsorted(of[by], np.arange(len(seen))))
            g = s.T @ h
            sums[0] += g * g
            sums[1][seen] += to_e * to_e
            u += 0.1 * g / np.sqrt(sums[0])
            e[seen] += 0.1 * to_e / np.sqrt(sums[1][seen])
    out = np.empty(len(word), np.float32)
    for a in range(0, len(word), 4096):
        i = np.arange(a, min(a + 4096, len(word)))
        s = model(i)[1]
        out[i] = s[np.arange(len(i)), word[i]] - np.log(np.exp(s).sum(1)) - log_p[word[i]]
    return out


def _rows_of(steps: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows from, per word of n items, the first row and the differences behind it."""
    total = np.cumsum(steps.astype(np.int64))
    first = np.cumsum(n) - n
    return (total - np.repeat(total[first] - steps[first], n)).astype(np.uint32)


def _train_words(held, vocabulary):
    """An owner's work: fit its lists, answer every message with its items' log10 of model over unigram, added up per row."""
    def run(table: pa.Table) -> pa.Table:
        m = held.value[0]
        table = table.sort_by("block")
        hashes = [decode(k) for k in table["keys"].to_pylist()]
        told = [[unpack(x, t) for x, t in zip(_unbundle(c), (np.uint64, np.uint32))] for c in table["counts"].to_pylist()]
        items = [_unbundle(b) for b in table["items"].to_pylist()]
        n_own = [t[1].astype(np.int64) for t in told]
        sizes = [int(n.sum()) for n in n_own]
        name = np.concatenate([unpack_rising(b[0]).astype(np.uint32)[unpack(b[1], np.uint32)] for b in items])
        row = np.concatenate([_rows_of(unpack(b[2], np.uint32), n) for b, n in zip(items, n_own)])
        v2 = np.concatenate([unpack(b[3], np.uint16) for b in items])
        learn, v2 = v2 < 1 << 15, v2 & (1 << 15) - 1
        v1 = np.where(name == 0, m.r.shape[1] - 1, vocabulary.value.low_classes(name))
        own, first, of = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        total = np.concatenate([t[0] for t in told])[first].astype(np.float64) + SMOOTH
        word = np.repeat(of, np.concatenate(n_own))
        shared = (own & U(SHARED - 1)).astype(np.int64)
        place = np.empty(len(own), np.int64)  # of each token, by (class, hash)
        order = np.argsort(shared, kind="stable")
        place[order] = np.arange(len(own))
        heads = np.searchsorted(shared[order], np.arange(SHARED + 1))
        lists = np.unique(np.concatenate([np.arange(a, b, WORDS) for a, b in zip(heads[:-1], heads[1:])] + [heads[-1:]]))
        word, total = place[word], total[order]
        by = np.argsort(word, kind="stable")
        cuts = np.searchsorted(word[by], lists)
        out = np.zeros(len(word), np.float32)
        for k, (a, b) in enumerate(zip(lists[:-1], lists[1:])):
            i = by[cuts[k]: cuts[k + 1]]
            if b - a > 1:
                x = m.r[0][v1[i]] + m.r[1][v2[i]]
                out[i] = fit_list(word[i] - a, np.unique(name[i], return_inverse=True)[1], x, learn[i],
                                  total[a:b] / total[a:b].sum(), k)
        out /= np.float32(np.log(10))
        ends, rows, scores = np.cumsum(sizes), [], []
        for n, e in zip(sizes, ends):
            mine, of = np.unique(row[e - n: e], return_inverse=True)
            rows.append(pack_rising(mine))
            scores.append(pack(np.bincount(of, out[e - n: e]).astype(np.float32)))
        return pa.table({"block": table["block"], "owner": table["shard"], "rows": pa.array(rows, pa.binary()),
                         "scores": pa.array(scores, pa.binary())})
    return run


def _add_words(docs: pa.Table, replies: pa.Table) -> pa.Table:
    """One block: the owners' answers added to its documents' scores."""
    row = docs["row"].to_numpy()
    words = np.zeros(row.max(initial=0) + 1)
    for i in np.argsort(replies["owner"].to_numpy()):
        words[unpack_rising(replies["rows"][i].as_py())] += unpack(replies["scores"][i].as_py(), np.float32)
    score = docs["class_score"].to_numpy() + docs["rest_score"].to_numpy() + words[row]
    return docs.select(["doc_id", "held_out", "n_tokens", "n_known", "base_score"]).append_column("score", pa.array(score))


def _score_task(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, log_z = held.value
        start = m.r.shape[1] - 1
        for batch in batches:
            scores = np.empty(batch.num_rows)
            _, offsets = string_bytes(batch.column(6))
            for a, b in slices(offsets, 1 << 19):
                rows = [np.frombuffer(x, np.uint16) for x in batch.column(6).slice(a, b - a).to_pylist()]
                first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
                w = np.concatenate(rows).astype(np.int64)
                v1, v2 = contexts(w, first, start)
                s = np.einsum("nd,nd->n", m.r[0][v1] + m.r[1][v2], m.q[w]) + m.b[w] - log_z[v1, v2]
                scores[a:b] = np.add.reduceat(s.astype(np.float64), first[:-1]) / np.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(scores), *batch.columns[7:]],
                                                  [*batch.schema.names[:6], "class_score", *batch.schema.names[7:]])
    return run


def score_texts(docs: DataFrame, classes: int = CLASSES) -> DataFrame:
    """Per row of docs (doc_id, held_out, text): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score; learned from the rows not held out."""
    spark = docs.sparkSession
    frequent = classes - SHARED - 1
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.coalesce("text", F.lit("")).alias("text"))
    owners = OWNERS_PER_PARTITION * shuffle_partitions(spark)
    sent = stage(source.mapInArrow(_send(owners), _SENT_SQL), "lm-sent")
    counter = _count(frequent)
    counted = stage(sent.where("kind = 'message'").select("block", "owner", "message", "counts").groupBy("owner")
                    .applyInArrow(counter, _COUNTED_SQL), "lm-counted")
    sums = (counted.where("kind = 'sum'").groupBy("block").agg(F.sum("token").alias("v"), F.sum("n").alias("n"))
            .toPandas().set_index("block").reindex(range(SHARED), fill_value=0))
    top = counted.where("kind = 'top'").orderBy(F.desc("n"), "token").limit(frequent).select("token", "n").toPandas()
    vocabulary = Vocabulary(top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64),
                            sums["n"].to_numpy(np.int64), sums["v"].to_numpy(np.int64))
    told = spark.sparkContext.broadcast(vocabulary)
    of_block = _block_scores(told)
    blocks = stage(sent.select("kind", "block", "owner", "message", "tokens", "ids", "flags", "sizes").groupBy("block").cogroup(
        counted.where("kind = 'reply'").select("block", "owner", "counts").groupBy("block"))
        .applyInArrow(of_block, _SCORED_SQL), "lm-blocks")
    model = _train(_merge(blocks), vocabulary)
    held = spark.sparkContext.broadcast((model, model.normalisers()))
    answers = (blocks.where("kind = 'words'").select("block", "shard", "keys", "counts", "items").groupBy("shard")
               .applyInArrow(_train_words(held, told), "block long, owner int, rows binary, scores binary"))
    classes = (blocks.where("kind = 'doc'")
               .select("doc_id", "held_out", "n_tokens", "n_known", "base_score", "rest_score", "classes", "block", "row")
               .mapInArrow(lambda it: _score_task(held)(it), "doc_id long, held_out boolean, n_tokens long, n_known long, "
                           "base_score double, rest_score double, class_score double, block long, row long"))
    out = classes.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _add_words, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(vocabulary.n).cast("long").alias("train_tokens"),
                      "base_score", "score")


def lm_scores(docs: DataFrame) -> DataFrame:
    """All texts, learned from the folds 1 to 9 of 10."""
    return score_texts(docs.select("doc_id", (fold_of("doc_id", 10) == 0).alias("held_out"), "text"))
