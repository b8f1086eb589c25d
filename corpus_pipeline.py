"""Corpus pipeline: documents to packed training sequences, in five stages.

1. ``language_id``: documents without a recognisable language go (no letter, or
   no n-gram that any learned language knows).
2. ``exact_dedup``: of equal texts (white space aside) one document stays.
3. ``near_dedup``: of documents linked by 5-word Jaccard >= 0.75 the one with the
   smallest id stays.
4. ``decontaminate``: documents that share 10 consecutive words with a benchmark
   item (or hold a shorter item whole) go.
5. ``pack``: the rest as pieces of sequences of at most 2048 token ids.

Each stage reads what the one before wrote. Stages 1 to 4 return the columns of
``documents``. SQL cannot express stages 1 and 5, so ``ORACLE_SQL`` is None and
``tests/llm`` holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowscope.llm import decontam, dedup, jaccard, kkpack, langid
from flowscope.llm.common import fold_of, keyed, read_table, stage, without


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    filters = langid.train(docs.where(fold_of("doc_id", 3) != 1).select("doc_id", "text", "lang"))
    columns = [c for c in docs.columns if c != "doc_id"]
    found = langid.predict(docs.select("doc_id", *(F.col(c).alias(f"_{c}") for c in columns), "text"), filters,
                           keep=[f"_{c}" for c in columns])
    return found.where("lang_pred <> 'und' and score > 0").select("doc_id", *(F.col(f"_{c}").alias(c) for c in columns))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = keyed(docs)
    return without(docs, dedup.exact_dedup(docs, key_col="_flowscope_key").where("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = keyed(docs)
    return without(docs, jaccard.similar_components(docs, key_col="_flowscope_key").where("not first_row"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = keyed(docs)
    found = decontam.contamination(docs.select(F.col("_flowscope_key").alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("n_hit > 0").select(F.col("doc_id").alias("key")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kkpack.pack(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("pack", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
