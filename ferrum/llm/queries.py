"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferrum.llm import bwt_dedup, chat, conversations, decontaminate, divergence, licenses, line_dedup, mixing, sharding
from ferrum.llm.base import documents, table
from ferrum.llm.near_dup import near_duplicates
from ferrum.llm.pii import personal_data
from ferrum.llm.quality import verdicts
from ferrum.llm.toxicity import toxicity


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=3, percent=85)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(documents(spark, sf_dir)).drop("kept")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.dedup(documents(spark, sf_dir), length=100).drop("kept")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"), threshold=0.3)


def op9_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.reshard(documents(spark, sf_dir), old_shards=32, new_shards=40)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damaged(turns), turns)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir), least_docs=10, top=10)


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_minhash_near_dedup, op3_mix_sources, op4_line_dedup, op5_decontaminate,
                                  op6_suffix_array_dedup, op7_license_scan, op8_toxicity, op9_reshard, op10_chat_format,
                                  op11_personal_data, op12_conversation_repair, op13_source_divergence)}
ORACLE: dict[str, str] = {"op7_license_scan": licenses.oracle(), "op10_chat_format": chat.ORACLE,
                          "op12_conversation_repair": conversations.ORACLE, "op13_source_divergence": divergence.ORACLE}
