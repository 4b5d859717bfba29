"""From raw documents to token ids: language, quality, near duplicates, benchmark leaks, BPE.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame; all but the last return the columns of documents.  ``run`` writes each stage's result as
Parquet in the shared folder and rereads it as the next one's docs.  A null text has no language
and goes in the first stage; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import bpe, decontam, langid, quality, simhash
from tillroll.llm.common import written
from tillroll.llm.queries import table, tokenizer_file, word_pattern


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled documents; the others go."""
    return langid.accepted(docs, langid.learn(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tail probability of the top grade reaches one half; the others go."""
    return quality.selected(docs, quality.train(docs, quality.graded(table(spark, sf_dir, "labels")), 3))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, 3 bits)."""
    return simhash.one_of_each(docs, n=3, max_bits=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document that is left."""
    return bpe.round_trip(docs, tokenizer_file(), word_pattern())


STAGES = [("language", language), ("quality", good_quality), ("near duplicates", near_duplicates),
          ("decontamination", without_benchmark), ("bpe", token_ids)]

ORACLE_SQL = None  # learnt models and hashes; tests compare the rows with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
