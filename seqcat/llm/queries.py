"""Registered queries of the text operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqcat.llm import (
    chat, decontaminate, exact_dedup, fill_middle, lm_scoring, mixing, near_dedup, prefix_trie, sharding, simhash, substrings, token_counts, toxicity)
from seqcat.llm.common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op1_sharding(spark, table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op2_mixing(spark, table(spark, sf_dir, "documents"), sf_dir)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.op3_exact_dedup(spark, table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op5_decontaminate(spark, table(spark, sf_dir, "documents"), sf_dir)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.op7_token_counts(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op8_chat(spark, table(spark, sf_dir, "conversations"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.op9_near_dedup(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.op10_lm_scoring(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op4_toxicity(spark, table(spark, sf_dir, "documents"), sf_dir)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.op6_substring_dedup(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.op11_prefix_trie(table(spark, sf_dir, "conversations"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.op12_fill_in_middle(table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op13_simhash(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_mixing, op3_exact_dedup, op5_decontaminate, op7_token_counts, op8_chat, op9_near_dedup, op10_lm_scoring, op4_toxicity, op6_substring_dedup,
                                 op11_prefix_trie, op12_fill_in_middle, op13_simhash)}
ORACLE = {"op3_exact_dedup": exact_dedup.ORACLE, "op5_decontaminate": decontaminate.ORACLE, "op8_chat": chat.ORACLE,
          "op9_near_dedup": near_dedup.ORACLE, "op11_prefix_trie": prefix_trie.ORACLE, "op12_fill_in_middle": fill_middle.ORACLE}
