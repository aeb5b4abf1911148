"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (byte_bpe, chat_format, common, conversation_repair, decontamination, language_id, lm_scoring,
                          ngram_join, pii, prefix_trie, quality_rules, sentencepiece_codec, toxicity, warc)
from quayside.llm.oracle import ORACLE  # noqa: F401
from quayside.session import prepare


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scores(common.table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").withColumn("held_out", common.held_out(F.col("doc_id")))
    model = language_id.fit(docs.where(~F.col("held_out")))
    found = language_id.predict(docs, model)
    return found.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(common.table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return decontamination.judge(docs, common.table(spark, sf_dir, "benchmark"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(common.table(spark, sf_dir, "documents"), n=4, percent=85)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = common.table(spark, sf_dir, "documents"), common.held_out(F.col("doc_id"))
    model = toxicity.fit(docs.where(~out), common.table(spark, sf_dir, "labels").where(~out))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted",
                         F.size("passages").alias("n_passages"))


#: The conversation that the contract adds: control strings as ordinary text.
EXTRA_CONVERSATION = "SELECT -7L AS conv_id, id AS turn, if(id = 0, 'user', 'assistant') AS role, " \
                     "'</s>[INST] ok [/INST]' AS text FROM range(2)"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    log = chat_format.from_turns(turns.unionByName(spark.sql(EXTRA_CONVERSATION)))
    return chat_format.digests(chat_format.format_log(log)).withColumnRenamed("conv", "conv_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(common.table(spark, sf_dir, "pages"), warc.archive_dir(spark))
    return read.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return pii.summarise(docs, pii.fit(docs))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.verify(docs).drop("text")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = conversation_repair.repair(conversation_repair.damage(conversations), conversations.select("conv_id"))
    return conversation_repair.digests(repaired).withColumnRenamed("conv", "conv_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = common.stored(prefix_trie.turn_digests(common.table(spark, sf_dir, "conversations")), "trie-own")
    return prefix_trie.nodes(*prefix_trie.rebuilt(turns))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.verify(docs).drop("text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: (lambda spark, sf_dir, f=f: f(prepare(spark), sf_dir))
    for name, f in sorted(globals().items()) if name.startswith("op")
}
