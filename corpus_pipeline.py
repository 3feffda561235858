"""Corpus pipeline: documents -> a mixed, sharded training corpus.

Toxic documents go; of each group of near duplicates one stays; documents contaminated by the benchmark go;
sources are mixed to their target weights; the mix is dealt out to shards.  Every stage is written as Parquet in
the shared scratch folder and read again by the next.

Defined results: each stage keeps the rules of its operator for nulls, empty texts, ties and repeated rows;
an empty documents table gives an empty result; extra columns of the documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqcat.llm import decontaminate, mixing, near_dedup, sharding, toxicity
from seqcat.llm.common import staged, table

N_SHARDS = 24
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field scores below one half."""
    return toxicity.clean_documents(spark, docs, sf_dir)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the smallest id's, of each group of documents linked at ``NEAR_PERCENT``; every row without words."""
    return near_dedup.one_of_each(docs, percent=NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words fewer than one in 20 lie in a benchmark window."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs, table(spark, sf_dir, "labels"))


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with its virtual slot and shard."""
    return sharding.with_shards(docs, N_SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: The field's score and the near-duplicate components have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
