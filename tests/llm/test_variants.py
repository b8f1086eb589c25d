"""Spelling groups against deletion neighbourhoods in plain Python."""

import collections
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowscope.llm import variants
from tests.conftest import SF_SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    count = collections.Counter()
    for d, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 199 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            if len(w) >= 6:
                count[w] += 1
    count = {w: n for w, n in count.items() if n >= 5}
    near, holes = {w: set() for w in count}, collections.defaultdict(set)
    for w in count:
        for k in range(len(w)):
            holes[w[:k], w[k + 1:]].add(w)
            x = w[:k] + w[k + 1:]
            if x in count:
                near[w].add(x)
                near[x].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, s in near.items():
        best = min(s, key=lambda x: (-count[x], x), default=None)
        if best and count[best] >= 5 * count[w]:
            form[w] = best
    out = {}
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), count[form[w]] if w in form else None)
    return out


def run(docs):
    rows = variants.spelling_groups(docs).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def made_rows():
    rng = random.Random(2)
    rows = [(None, None), (1, ""), (2, " "), (3, "Straße ÀÉÎ÷ÿ " * 9), (4, "AAAAAA aaaaaa aaaaaaa aaaaaaaa " * 30)]
    word = "correction"
    rows += [(10 + i, f"{word} " * 40) for i in range(20)]
    rows += [(50, "corection " * 30 + "corecton " * 6 + "correctian " * 6), (50, "corection " * 30), (None, "corrections " * 200)]
    rows.append((60, ("z" * 5000 + " ") * 6 + ("z" * 4999 + " ") * 31))
    letters = "abcdeé"
    for i in range(300):  # many anagrams and near words in few blocks
        w = [*"aabbccddeé"]
        rng.shuffle(w)
        w = "".join(w)
        rows.append((100 + i, f"{w} " * 5 + (w[:4] + rng.choice(letters) + w[5:] + " ") * 6))
    return rows


def test_groups_equal_brute_force(spark):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(3) for c in ("word", "n", "tile", "w", "id")})
    want = brute(rows)
    assert run(docs) == want
    assert want["corecton"][:2] == ("corection", "correction") and sum(v[0] is not None for v in want.values()) > 3
    assert run(docs.limit(0)) == {}


def test_blocks_in_several_tiles(spark, monkeypatch):
    """Blocks dealt to several tiles, and slabs cut in the middle of a tile, give the same rows."""
    monkeypatch.setattr(variants, "TILE", 7)
    rows = made_rows()
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=5), min_size=2, max_size=12, unique=True), st.integers(1, 4))
def test_pairs_of_one_edit(words, slab):
    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    old, variants.VISITORS = variants.VISITORS, slab
    try:
        zeros = np.zeros(len(words), np.int64)
        i, j = variants.near_pairs(words, zeros, words, zeros, np.ones(len(words), bool))
    finally:
        variants.VISITORS = old
    got = sorted((words[a], words[b]) for a, b in zip(i.tolist(), j.tolist()))
    assert got == sorted((a, b) for a in words for b in words if b < a and near(a, b))
