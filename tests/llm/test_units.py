"""numpy and pure-Python parts against simple versions."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from flowscope.llm import binpack, kkpack
from flowscope.llm.common import slices, string_bytes
from flowscope.llm.exchange import cut_by_owner, decode, encode
from flowscope.llm.textnum import LOWER, NOT_SPACE, grams, span_hashes, word_spans
from flowscope.llm.tokens import default_tokenizer, tokenizer


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=200), st.integers(1, 50))
def test_messages_round_trip(values, owners):
    v = np.array(sorted(values), np.uint64)
    assert (decode(encode(v)) == v).all()
    parts = cut_by_owner(v, owners)
    assert sum(b - a for _, a, b in parts) == len(v)
    assert [p[0] for p in parts] == sorted({p[0] for p in parts})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n\t.x", max_size=20), max_size=8))
def test_words_and_hashes(texts):
    raw, offsets = string_bytes(pa.array(texts, pa.string()))
    data = LOWER[raw]
    starts, ends, first = word_spans(data, offsets, NOT_SPACE)
    words = [bytes(data[a:b]) for a, b in zip(starts, ends)]
    lower = str.maketrans("B", "b")
    want = [[w.encode() for w in t.translate(lower).split()] for t in texts]
    assert [words[a:b] for a, b in zip(first[:-1], first[1:])] == want
    h = span_hashes(data, starts, ends)
    assert len(set(h.tolist())) == len(set(words))
    assert len(grams(h, 3)) == max(0, len(words) - 2)


def test_ids_equal_those_of_whole_texts():
    from tokenizers import Tokenizer
    texts = ["Hello, World's don't 3.14 a1b2", "ÉCOLE naïve × ÷ “quoted” — x…y", "", "   ", "'s 't", "STRASSE ẞ ß İ Σας",
             "áb é, ̀x  <|endoftext|>a", "日本語 テスト 🎉🎉!! ok", "tab nbsp em x", "½ ² Ⅷ a²b", "word " * 3000]
    whole = Tokenizer.from_file(default_tokenizer())
    whole.encode_special_tokens = True
    raw, offsets = string_bytes(pa.array(texts))
    for a, b in slices(offsets):
        ids, first = tokenizer(default_tokenizer()).encode(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
        for i in range(a, b):
            assert ids[first[i - a]: first[i - a + 1]].tolist() == whole.encode(texts[i], add_special_tokens=False).ids


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=40), st.booleans())
def test_packing_keeps_every_id_once(sizes, cut):
    packer = kkpack.Packer(0, 16, cut)
    docs = [np.arange(n, dtype=np.uint32) + 1000 * i for i, n in enumerate(sizes)]
    for i, d in enumerate(docs):
        packer.add(i, d)
    packer.finish()
    rows = packer.drain().to_pylist()
    for i, d in enumerate(docs):
        mine = sorted((r["start"], r["ids"]) for r in rows if r["doc_id"] == i)
        assert b"".join(x for _, x in mine) == d.astype("<u4").tobytes()
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        total = sum(n for _, n in parts)
        assert total <= 16 and (not cut or total & (total - 1) == 0)


def test_differencing_raises_the_window_count():
    pieces = [kkpack.Piece(i, 0, np.zeros(9, np.uint32), 9) for i in range(3)]
    assert len(kkpack.windows_of(pieces, 16, cut=False)) == 3
    assert kkpack.karmarkar_karp([], 3) == [[], [], []]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=40))
def test_best_fit_decreasing(sizes):
    rows = binpack.best_fit_decreasing(sizes, 32)
    assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
    room = []  # the plain search
    for s in sorted(sizes, reverse=True):
        fits = [x for x in range(len(room)) if room[x] >= s]
        at = min(fits, key=lambda x: room[x]) if fits else len(room)
        if not fits:
            room.append(32)
        room[at] -= s
    assert sorted(32 - sum(sizes[i] for i in r) for r in rows) == sorted(room)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=60), st.lists(st.integers(1, 4), max_size=20))
def test_packed_arrays(values, sizes):
    from flowscope.llm import lm
    a = np.array(values, np.uint32)
    assert (lm.unpack(lm.pack(a), np.uint32) == a).all()
    up = np.sort(a.astype(np.uint64) << np.uint64(7))
    assert (lm.unpack_rising(lm.pack_rising(up)) == up).all()
    n = np.array(sizes, np.int64)
    rows = np.concatenate([np.sort(np.resize(a, k)) for k in sizes] or [a[:0]]) if len(a) else np.zeros(n.sum(), np.uint32)
    word = np.repeat(np.arange(len(n)), n)
    if len(word):
        heads = np.r_[True, word[1:] != word[:-1]]
        assert (lm._rows_of(np.where(heads, rows, np.diff(rows, prepend=np.uint32(0))), n) == rows).all()


def test_a_model_sums_to_one():
    """All class probabilities of any context of a trained model, and those of a list, add up to one."""
    from flowscope.llm import lm
    rng = np.random.default_rng(3)
    p = rng.random(20) + 0.1
    model = lm.LogBilinear(p / p.sum())
    v1, v2 = rng.integers(0, 21, 100_000), rng.integers(0, 21, 100_000)
    w = (v1 + 1) % 20  # the class follows from the one before
    model.nce(v1, v2, w, np.ones(len(w), np.float32), rng)
    score = (model.r[0][:, None, None] + model.r[1][None, :, None]) @ model.q.T
    log_p = score[:, :, 0] + model.b - model.normalisers()[:, :, None]
    assert np.allclose(np.exp(log_p).sum(2), 1, atol=1e-3)
    unigram = np.log(p / p.sum())[w].mean()
    assert log_p[v1, v2, w].mean() > unigram + 0.5
