"""Languages with few training rows, many languages, held-out accuracy."""

import random

from pyspark.sql import functions as F

from flowscope.llm import langid

SF_CHECK = "/root/testdata/sf0.01"


def prose(rng, letters, n=60):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(n))


def test_one_training_row_is_learned_from(spark):
    rng = random.Random(1)
    swahili = "watu wote wanazaliwa huru wakiwa na heshima na haki sawa " * 3
    rows = [(i, prose(rng, "etaoinsh"), "en") for i in range(40)] + [(100, swahili, "sw")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = langid.train(docs)
    asked = spark.createDataFrame([(1, swahili), (2, prose(rng, "etaoinsh")), (3, "wanazaliwa huru"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(asked, filters).collect()}
    assert got == {1: "sw", 2: "en", 3: "sw", 4: "und"}


def test_more_languages_than_bits_of_a_word(spark):
    rng = random.Random(2)
    alphabet = [chr(0x400 + k) for k in range(64)]
    own = [rng.sample(alphabet, 5) for _ in range(70)]
    rows = [(100 * k + j, prose(rng, own[k], 80), f"l{k:02d}") for k in range(70) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = langid.train(docs)
    assert len(filters.masks) == 2
    asked = spark.createDataFrame([(k, prose(rng, own[k], 80)) for k in range(70)], "doc_id long, text string")
    got = langid.predict(asked, filters).collect()
    assert sum(r.lang_pred == f"l{r.doc_id:02d}" for r in got) >= 68


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = langid.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where(
        "lang IS NOT NULL AND lang_pred <> 'und'")
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 200 and right >= 0.98 * n
