"""Operators on awkward rows, against brute force."""

import collections
import hashlib
import math
import re
import zlib

import pytest
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from flowscope.llm import binpack, chat, decontam, dedup, jaccard, kkpack, langid, lm, quality, sharding
from flowscope.llm.exchange import encode

LONG = " ".join(f"w{i}" for i in range(400))
ROWS = [
    (1, "Same text here, twice over for all of us to see", "en"), (2, "Same text here,  twice over\nfor all of us to see", "en"),
    (3, None, None), (4, "", "en"), (5, " \t\n", "fr"), (6, "one", "en"), (6, "one", "en"), (None, "one", None),
    (7, "Ünïcödé ÄÖ ß", "de"), (8, "12345 !!! ***", "en"), (9, LONG, "en"), (10, LONG.replace("w200", "zz"), "en"),
    (11, LONG.replace("w200", "zz").replace("w100", "yy"), None), (12, LONG + " " + LONG, "en"),
    (13, "a b c d e", "en"), (14, "A B C D E", "en"), (15, "a b c d", "en"), (16, LONG.replace("w", "v"), "fr"),
] + [(100 + i, " ".join(f"g{j}" if j % 50 != i % 50 else f"e{i}" for j in range(60)), "es") for i in range(40)]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    extra = {c: F.lit(5) for c in ("row", "key", "sha", "n", "label", "score", "block", "norm")}
    return spark.createDataFrame(ROWS, SCHEMA).withColumns(extra)


def lowered(t):
    return (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_exact_dedup(spark, docs):
    got = dedup.exact_dedup(docs).collect()
    assert len(got) == len(ROWS)
    groups = collections.defaultdict(list)
    for d, t, _ in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), 2**63 if d is None else d, d))
    for r in got:
        own = next(g for n, g in groups.items() if hashlib.sha256(n.encode()).hexdigest() == r.text_sha256)
        assert (r.group_size, r.keep_id) == (len(own), min(own)[2])
    assert sum(r.kept for r in got) == len(groups)
    assert dedup.exact_dedup(docs.limit(0)).count() == 0


def brute_components(rows):
    sets = []
    for _, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if o and 100 * o >= 75 * len(a | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for x, (d, _, _) in zip(label, rows):
        least[x] = min([v for v in (least.get(x), d) if v is not None], default=None)
    return sorted(((d, len(s), least[x]) for (d, _, _), s, x in zip(rows, sets, label)), key=str)


def test_jaccard_components(spark, docs):
    out = jaccard.similar_components(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == brute_components(ROWS)
    # one row of each component stays (documents without words are components of their own)
    sizes = collections.Counter(r.component_id for r in out if r.first_row)
    assert all(n == 1 for n in sizes.values())


def test_jaccard_counts_of_very_long_texts():
    """Two rows in different blocks share 70,000 prefix hashes with one owner."""
    h = np.unique(np.random.default_rng(1).integers(0, 2**63, 70_000, np.uint64))
    members = np.packbits(np.ones(len(h), bool)).tobytes() + np.zeros(len(h), np.uint16).tobytes()
    sent = pa.table({"block": pa.array([0, 1]), "row": pa.array([0, 5]), "message": pa.array([encode(h)] * 2, pa.binary()),
                     "members": pa.array([members] * 2, pa.binary())})
    answers = jaccard._count_shared(sent)
    for block, row in ((0, 0), (1, 5)):
        mine = answers.filter(pc.equal(answers["block"], block))
        assert jaccard._sum_shared(mine).to_pylist() == [{"row": row, "shared": len(h)}]


def test_decontamination(spark, docs):
    items = [(1, " ".join(f"W{i}" for i in range(50, 75))), (2, "a  B"), (2, "one"), (None, "ß"), (4, None), (5, "..."),
             (6, "w300 w301 w302 w303 w304 w305 w306 w307 w308 nope w309")]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))

    want = []
    for d, t, _ in ROWS:
        w, hit, found = words(t), set(), set()
        for i, text in items:
            b = words(text)
            n = min(10, len(b))
            for s in {tuple(b[k:k + n]) for k in range(len(b) - n + 1)} if b else ():
                for k in range(len(w) - n + 1):
                    if tuple(w[k:k + n]) == s:
                        hit |= set(range(k, k + n))
                        found.add("null" if i is None else str(i))
        want.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    for block_words in (4_000_000, 1):  # one block, and a block per item
        got = decontam.contamination(docs, bench, block_words=block_words)
        rows = got.select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ",").cast("binary"), 256),
                          F.col("n_hit") > 0).collect()
        assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert decontam.contamination(docs, bench.limit(0)).where("n_hit > 0").isEmpty()


def test_lm_base_score_is_exact_and_empty_input_works(spark, docs):
    got = lm.lm_scores(docs.where("doc_id is not null")).collect()
    rows = [r for r in ROWS if r[0] is not None]
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", lowered(t)) + [None] for _, t, _ in rows]
    held = [zlib.crc32(str(d).encode()) % 10 == 0 for d, _, _ in rows]
    c = collections.Counter(x for t, h in zip(tokens, held) if not h for x in t)
    n, v = sum(c.values()), len(c)
    want = sorted((d, len(t), sum(c[x] > 0 for x in t), n, round(sum(math.log10((c[x] + .1) / (n + .1 * (v + 1))) for x in t), 6))
                  for (d, _, _), t in zip(rows, tokens))
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert lm.lm_scores(docs.limit(0)).count() == 0


def test_lm_learns_words_beyond_the_classes(spark):
    """1500 pairs of words with one ending: far more than the classes, which cannot tell them apart."""
    i = F.col("id")
    pair, kind = i % 1500, F.floor(i / 1500)
    text = F.concat_ws(" ", F.concat(F.lit("a"), pair.cast("string"), F.lit("ing")),
                       F.concat(F.lit("b"), F.when(kind == 9, (pair + 7) % 1500).otherwise(pair).cast("string"), F.lit("ing")))
    docs = spark.range(0, 15000, 1, 3).select(i.alias("doc_id"), (kind >= 8).alias("held_out"), text.alias("text"))
    got = {r.doc_id: r.score for r in lm.score_texts(docs).collect()}
    right, wrong = (sum(got[k * 1500 + j] for j in range(1500)) / 1500 for k in (8, 9))
    assert right > wrong + 0.02, (right, wrong)


def test_lm_list_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    word, name, x = rng.integers(0, 9, 5000), rng.integers(0, 40, 5000), rng.standard_normal((5000, lm.SIZE)).astype(np.float32)
    every = np.arange(9)  # all words of the list in one context, not learned from
    p = np.arange(1, 10) / 45
    out = lm.fit_list(np.append(word, every), np.append(name, np.full(9, 5)), np.vstack([x, np.repeat(x[:1], 9, 0)]),
                      np.append(np.ones(5000, np.float32), np.zeros(9, np.float32)), p, 1)[-9:]
    assert abs((p * np.exp(out)).sum() - 1) < 1e-4 and np.abs(out).max() > 0.01


def test_language_and_quality_rows(spark, docs):
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[8].lang_pred == "und" and got[9].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    labels = spark.createDataFrame([(9, 1), (9, None), (16, 0), (None, 1), (8, 0), (8, 1)], "doc_id long, quality int")
    for marks in (labels, labels.limit(0)):
        out = quality.quality_scores(docs, marks).collect()
        assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)


def test_packing_and_binary_output_are_lossless(spark, docs):
    rows = kkpack.pack(docs).collect()
    assert sum(r.length for r in rows if r.start == 0) and all(r.ids_crc32 == zlib.crc32(r.ids) for r in rows)
    per = collections.Counter()
    for r in rows:
        per[r.doc_id] += r.length
    once = [d for d, _, _ in ROWS if d is not None and d != 6]
    assert all(per[d] == next(r.doc_tokens for r in rows if r.doc_id == d) for d in once)
    packed = binpack.write_packed(docs, length=64)
    stored = packed.collect()
    assert sum(r.n_tokens for r in stored) == sum(r.length for r in rows)
    assert all(len(r.ids) == 128 and r.cu_seqlens[-1] == r.n_tokens <= 64 for r in stored)
    assert kkpack.pack(docs.limit(0)).count() == 0


def test_sharding_law(spark, docs):
    big = docs.select("doc_id", "text", "lang").unionByName(spark.range(1000, 1300).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"),
        F.lit("en").alias("lang")))
    got = sharding.balanced_shards(big, shards=7).collect()
    assert len(got) == len(ROWS) + 300
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(s) for s in slots.values()]
    assert max(counts) - min(counts) <= 1
    hot = collections.Counter(r.shard for r in got if r.text_crc32 == zlib.crc32(b"hot"))
    assert len(hot) <= 3  # 100 equal texts need two shards of 51; hashing would use all seven
    assert sharding.balanced_shards(big.limit(0)).count() == 0


def _links(rows):
    """Shards of the text "hot", and other groups of equal texts in more than one shard."""
    shards = collections.defaultdict(set)
    for r in rows:
        shards[r.size, r.text_crc32].add(r.shard)
    hot = shards.pop((19, zlib.crc32(b"hot")), set())
    return len(hot), sum(len(s) > 1 for s in shards.values())


def test_sharding_keeps_groups_together(spark):
    i = F.col("id")

    def texts(text):
        return spark.range(0, 40000, 1, 4).select(i.alias("doc_id"), text.alias("text"))

    single = F.concat(F.lit("single "), i.cast("string"))
    pair = F.concat(F.lit("pair "), F.expr("id div 2").cast("string"))
    hot = texts(F.when(i >= 26667, F.lit("hot")).when(i < 4000, pair).otherwise(single))
    cases = {"a third and 2000 pairs": (hot, 14), "18000 pairs": (texts(F.when(i < 36000, pair).otherwise(single)), 0),
             "pairs only": (texts(pair), 0)}
    for name, (table, want) in cases.items():
        got = sharding.balanced_shards(table, shards=40).collect()
        assert collections.Counter(r.shard for r in got) == dict.fromkeys(range(40), 1000), name
        in_hot, split = _links(got)
        assert in_hot == want and split <= 39, (name, in_hot, split)


def test_chat_events_fold(spark):
    events = spark.createDataFrame([
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "delta", "assistant", "a"), (1, 1, 2, "delta", "assistant", "b"),
        (1, 1, 3, "regenerate", "assistant", None), (1, 1, 4, "delta", "assistant", "c[/ANS]"), (1, 2, 5, "message", "user", "x"),
        (1, 0, 6, "edit", "user", "h\\0o"), (1, 1, 7, "delta", "assistant", "late"),
        (2, 0, 0, "message", "user", "q"), (2, 1, 1, "delta", "assistant", "1"), (2, 1, 2, "regenerate", "assistant", ""),
        (2, 1, 3, "delta", "assistant", "<s>"), (2, 1, 4, "delta", "assistant", "2"), (2, 2, 5, "message", "tool]", "t"),
        (None, None, 0, "message", None, None)], "conv_id long, turn long, seq long, kind string, role string, text string")
    back = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold_events(events))).collect()}
    assert [tuple(t) for t in back[2].turns] == [("user", "q"), ("assistant", "<s>2"), ("tool]", "t")]
    assert back[2].loss_texts == ["<s>2"] and [tuple(t) for t in back[None].turns] == [("", "")]
    assert [tuple(t) for t in back[1].turns] == [("user", "h\\0o")]  # the edit drops the turns written before it
    assert chat.chat_digest(events.limit(0)).count() == 0


def test_jaccard_later_rounds_move_only_what_is_left(spark, monkeypatch):
    """Pairs of copies settle in the first round; a family of near misses (0.66) takes more. Rounds
    after the first hold the sets that their index names, and no other."""
    words = lambda tag, n: [f"{tag}x{i}" for i in range(n)]
    rows = [(2 * p + side, " ".join(words(f"p{p}", 40) + [f"end{side}"])) for p in range(30) for side in (0, 1)]
    rows += [(1000 + d, " ".join(words("family", 80) + words(f"own{d}", 20))) for d in range(12)]
    live, moved = [], []
    candidates, overlaps = jaccard._candidates, jaccard._overlaps
    nodes = lambda df: {r.node for r in df.select("node").distinct().collect()}
    monkeypatch.setattr(jaccard, "_candidates", lambda index, *a: (live.append(nodes(index)), candidates(index, *a))[1])
    monkeypatch.setattr(jaccard, "_overlaps", lambda pairs, sets: (moved.append(nodes(sets)), overlaps(pairs, sets))[1])
    out = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == {d: d - d % 2 if d < 1000 else d for d, _ in rows}
    assert len(live) > 1 and moved[1:] == live[1:] and len(moved[1]) < len(moved[0])


def test_jaccard_first_round_moves_only_sets_of_pairs(spark, monkeypatch):
    """Rows made of passages that other rows have too are all in the index; one pair of them is worth comparing,
    and only its two sets move."""
    words = lambda tag, n: [f"{tag}x{i}" for i in range(n)]
    rows = [(d, " ".join(words(f"p{d}", 40) + words(f"p{(d + 7) % 20}", 40))) for d in range(20)]
    rows.append((50, rows[3][1] + " end"))
    live, moved = [], []
    candidates, overlaps = jaccard._candidates, jaccard._overlaps
    monkeypatch.setattr(jaccard, "_candidates", lambda index, *a: (live.append(index.select("node").distinct().count()), candidates(index, *a))[1])
    monkeypatch.setattr(jaccard, "_overlaps", lambda pairs, sets: (moved.append(sets.count()), overlaps(pairs, sets))[1])
    out = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == {d: 3 if d == 50 else d for d, _ in rows}
    assert live[0] == 21 and moved[0] == 2
    assert jaccard.similar_components(spark.createDataFrame(rows[:0], "doc_id long, text string")).count() == 0


def test_jaccard_index_is_the_rarest_first_prefix(spark):
    """Sets over several blocks, with hashes of one set, of two and of most."""
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**64, 300, np.uint64)
    sets = {node: np.unique(np.concatenate([rng.choice(pool, n, replace=False), pool[:3], rng.integers(0, 2**64, n // 6, np.uint64)]))
            for node, n in enumerate([1, 2, 5, 40, 40, 60, 90, 90, 120, 200])}
    df = collections.Counter(h for s in sets.values() for h in s.tolist())
    width = 10 + sum(map(len, sets.values())).bit_length()
    want = set()
    for node, s in sets.items():
        own = sorted((df[h], h >> (64 - width)) for h in s.tolist() if df[h] > 1)
        alone = len(s) - len(own)
        want |= {(key, node, len(s), alone + k) for k, (_, key) in enumerate(own) if k <= len(own) - -(-3 * len(s) // 4)}
    table = spark.createDataFrame([(n, len(s), s.view(np.int64).tolist()) for n, s in sets.items()], "node long, n long, items array<long>")
    index, signs = jaccard._prefix_index(table.repartition(3))
    assert {(r.item, r.node, r.n, r.pos) for r in index.collect()} == want and len(want) > 30
    native = jaccard._signatures(table, jaccard.FIRST_WORDS).drop("n", "items")
    assert sorted(map(tuple, signs.collect())) == sorted(map(tuple, native.collect()))
    ranks = jaccard._rank(np.arange(2, 10**6))
    assert (np.diff(ranks.astype(int)) >= 0).all() and ranks[-1] > ranks[1000]
