"""The corpus pipeline: each stage applies one operator to all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's
rows as Parquet to the shared work folder and rereads them as the next one's docs.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import packing, quality, repeats, simhash
from tessera.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once are cut out of the texts; every row stays."""
    return repeats.cleaned(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: the place of every piece of every document's ids."""
    return packing.documents(docs)


STAGES = [("quality_classifier", quality_classifier), ("simhash_near_dedup", simhash_near_dedup),
          ("suffix_array_dedup", suffix_array_dedup), ("best_fit_packing", best_fit_packing)]

#: No SQL: the classifier, the fingerprints and the tokenizer are not SQL functions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
