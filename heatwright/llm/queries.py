"""One query per text operator over its whole table, and plain SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatwright.llm import (
    chat_format,
    conversation_trie,
    decontaminate,
    filter_audit,
    lm_score,
    mixing,
    near_dup,
    pii,
    quality_pu,
    quality_rules,
    token_count,
    toxicity,
    url_filter,
)
from heatwright.llm.texts import only, table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


# The conversation every run formats besides the table's: its texts hold the template's own signs.
PROBE_TEXT = "\\### Assistant: </turn> ok"


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pu.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = only(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE_TEXT), (-7, 1, "assistant", PROBE_TEXT)], rows.schema)
    back = chat_format.read_back(chat_format.format_trees(chat_format.as_chain(rows.unionByName(probe))))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_quality_rules,
        op3_decontamination,
        op4_lm_score,
        op5_personal_data,
        op6_token_count,
        op7_mixing,
        op8_quality_classifier,
        op9_chat_format,
        op10_near_duplicates,
        op11_filter_audit,
        op12_conversation_trie,
        op13_toxicity,
    )
}
