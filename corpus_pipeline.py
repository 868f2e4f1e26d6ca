"""A training-corpus pipeline over the tables of one folder.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next one's documents.  All stages but
the last return the columns of ``documents``.  The last has the ids of every
document that is left.

Empty input gives an empty result; nulls are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import bpe_lexicon, decontamination, quality_rules, queries, simhash, toxicity
from forecourt.llm.common import table
from forecourt.session import write_scratch


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a grammar learned from the labelled ones among them."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), "toxic", ~queries.held_out(5, 0))
    return toxicity.keep_clean(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, and the digests of ids and decoded text."""
    coded = bpe_lexicon.encode_decode(docs, queries.vocabulary())
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", good), ("toxicity", civil), ("simhash_near_dedup", distinct),
          ("decontamination", unseen), ("bpe_encode_decode", encoded)]

#: SQL can express neither the suffix arrays nor the learned grammar nor BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = spark.read.parquet(write_scratch(stage(spark, docs, sf_dir), f"pipeline-{name}"))
    return docs
