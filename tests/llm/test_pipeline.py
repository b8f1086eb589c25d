"""Every stage of the pipeline, and all of them together, against plain Python on a small table."""

import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowscope.llm.tokens import default_tokenizer
from tests.llm.test_operators import brute_components, lowered

WORDS = {"en": "the house stands near old river and people walk along quiet streets every morning before work",
         "de": "das haus steht neben dem alten fluss und menschen gehen jeden morgen durch ruhige strassen zur arbeit",
         "fr": "la maison se trouve pres de la vieille riviere et les gens marchent chaque matin dans rues calmes"}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = [(1, "seven sealed boxes of copper wire were left behind under the wooden stairs"), (2, "zebra quartz"), (3, None), (None, "")]


def made_documents():
    rng, rows = random.Random(9), []

    def add(text, lang, source="web", doc_id=None):
        rows.append((len(rows) + 1 if doc_id is None else doc_id, text, lang, source, len(text) if text is not None else None))

    def prose(lang, n):
        return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))

    for lang in WORDS:
        for _ in range(14):
            add(prose(lang, rng.randrange(20, 90)), lang)
    base = prose("en", 300)
    for k in range(6):  # a family of near copies, hot source
        w = base.split()
        w[40 * k + 3] = "changed"
        add(" ".join(w), "en", "hot")
    for k in range(12):  # exact copies but for white space
        add(base.replace(" ", "  " if k % 3 else "\n"), "en", "hot")
    add(prose("fr", 30) + " seven SEALED boxes of copper, wire were left behind under the table", "fr")  # ten words
    add(prose("fr", 30) + " seven sealed boxes of copper wire were left", "fr")  # nine words: clean
    add(prose("de", 10) + " Zebra-Quartz " + prose("de", 10), "de")
    add(prose("de", 10) + " quartz zebra " + prose("de", 10), "de")
    for text in (None, "", " \n\t", "12345 --- !!!", "世界" * 40):
        add(text, None, None)
    add(prose("en", 40), None, "repeated", 7)
    add(prose("en", 40), "en", "repeated", 7)
    add(prose("de", 4000), "de", "long")
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame(made_documents(), SCHEMA).withColumns({c: F.lit(1) for c in ("key", "row", "score", "n", "kept")})
    docs.repartition(3).write.parquet(os.path.join(path, "documents.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(os.path.join(path, "benchmark.parquet"))
    return path


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def exact_kept(rows):
    best = {}
    for d, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best[key] = min(best.get(key, (1, 0, "")), (-len(t or ""), d, t or ""))
    return sorted((d, k) for k, (_, d, _) in best.items())


def contaminated(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    for _, item in ITEMS:
        b = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(item))
        n = min(10, len(b))
        grams = {tuple(b[k:k + n]) for k in range(len(b) - n + 1)} if b else set()
        if any(tuple(w[k:k + n]) in grams for k in range(len(w) - n + 1)):
            return True
    return False


def test_language_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.language_id(spark, docs, folder)
    assert kept.columns == docs.columns
    told = [r for r in made_documents()]
    # prose of a learned language stays; texts without a letter, or of letters no language has, go
    want = sorted(((d, t) for d, t, *_ in told if t and re.search("[a-z]", t)), key=str)
    assert rows_of(kept) == want


def test_exact_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.exact_dedup(spark, docs, folder)
    assert kept.columns == docs.columns
    got = rows_of(kept)
    keys = [re.sub(r"\s", "", t or "") for _, t in got]
    assert len(set(keys)) == len(keys)
    assert sorted((d, k) for (d, _), k in zip(got, keys)) == exact_kept(rows_of(docs))


def test_near_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.near_dedup(spark, docs, folder)
    assert kept.columns == docs.columns
    rows = rows_of(docs)
    # components over row numbers, as repeated ids are different documents
    comp = {i: c for i, _, c in brute_components([(i, t, None) for i, (_, t) in enumerate(rows)])}
    got = rows_of(kept)
    where = [rows.index(r) for r in got]
    assert len({comp[i] for i in where}) == len(got) == len(set(comp.values()))
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids[comp[i]] = min(ids.get(comp[i], 10**9), d)
    assert all(d == ids[comp[i]] for i, (d, _) in zip(where, got))


def test_decontamination_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.decontaminate(spark, docs, folder)
    assert kept.columns == docs.columns
    assert rows_of(kept) == [r for r in rows_of(docs) if not contaminated(r[1])]
    assert docs.count() - kept.count() == 2


def unpacked(out):
    pieces = {}
    for r in out.collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids, r.length, r.ids_crc32, r.sequence_id, r.offset))
    by = {}
    for parts in pieces.values():
        for _, ids, n, crc, sequence, offset in parts:
            assert len(ids) == 4 * n and zlib.crc32(ids) == crc
            by.setdefault(sequence, []).append((offset, n))
    for parts in by.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 2048
    return pieces


def ids_of(text):
    import numpy as np
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(default_tokenizer())
    tokenizer.encode_special_tokens = True
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()


def test_pack_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id <> 7")
    pieces = unpacked(corpus_pipeline.pack(spark, docs, folder))
    for d, t in rows_of(docs):
        assert b"".join(ids for _, ids, *_ in sorted(pieces.pop(d))) == ids_of(t)
    assert not pieces


def test_stages_on_an_empty_table(spark, folder):
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, empty, folder).count() == 0, name


def test_run(spark, folder):
    """All stages: what is packed is what plain Python keeps, each stage on the rows of the one before."""
    pieces = unpacked(corpus_pipeline.run(spark, folder))
    rows = [(d, t) for d, t, *_ in made_documents() if t and re.search("[a-z]", t)]
    by_key = {}
    for d, t in rows:
        key = re.sub(r"\s", "", t)
        by_key[key] = min(by_key.get(key, (1, 0, "")), (-len(t), d, t))
    rows = sorted((d, t) for _, d, t in by_key.values())
    comp = {i: c for i, _, c in brute_components([(i, t, None) for i, (_, t) in enumerate(rows)])}
    least = {}
    for i, (d, t) in enumerate(rows):
        least[comp[i]] = min(least.get(comp[i], (10**9, "")), (d, t))
    rows = [(d, t) for d, t in least.values() if not contaminated(t)]
    want = {}
    for d, t in rows:
        want.setdefault(d, []).append(ids_of(t))
    assert set(pieces) == set(want)
    for d, texts in want.items():
        if len(texts) == 1:
            assert b"".join(ids for _, ids, *_ in sorted(pieces[d])) == texts[0]
        else:  # two documents with one id
            assert sum(n for _, _, n, *_ in pieces[d]) == sum(len(x) // 4 for x in texts)
