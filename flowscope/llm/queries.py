"""The registered queries of this subpackage: name -> f(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowscope.llm import binpack, chat, decontam, dedup, fim, jaccard, kkpack, langid, lm, quality, secrets, sharding, variants
from flowscope.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("op1_decontaminate")
def op1_decontaminate(spark, sf):
    return decontam.contamination_digest(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


@query("op2_language_id")
def op2_language_id(spark, sf):
    return langid.identify(read_table(spark, sf, "documents"))


@query("op3_quality")
def op3_quality(spark, sf):
    return quality.quality_scores(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


@query("op4_lm_score")
def op4_lm_score(spark, sf):
    return lm.lm_scores(read_table(spark, sf, "documents"))


@query("op5_chat_format")
def op5_chat_format(spark, sf):
    turns = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)],
                                 "conv_id long, turn long, role string, text string")
    return chat.chat_digest(chat.turns_as_events(turns.unionByName(more)))


@query("op6_binary_output")
def op6_binary_output(spark, sf):
    return binpack.packed_digest(binpack.write_packed(read_table(spark, sf, "documents")))


@query("op7_exact_dedup")
def op7_exact_dedup(spark, sf):
    return dedup.exact_dedup(read_table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op8_pack")
def op8_pack(spark, sf):
    return kkpack.pack(read_table(spark, sf, "documents"), with_ids=False).drop("ids")


@query("op9_jaccard_join")
def op9_jaccard_join(spark, sf):
    return jaccard.similar_components(read_table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op10_shard")
def op10_shard(spark, sf):
    return sharding.balanced_shards(read_table(spark, sf, "documents"))


@query("op11_secrets")
def op11_secrets(spark, sf):
    return secrets.secret_digest(read_table(spark, sf, "documents"))


@query("op12_variants")
def op12_variants(spark, sf):
    return variants.spelling_groups(read_table(spark, sf, "documents"))


@query("op13_fill_in_middle")
def op13_fill_in_middle(spark, sf):
    return fim.fim_digest(read_table(spark, sf, "documents"))
