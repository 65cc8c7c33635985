"""Corpus pipeline: five stages over ``documents``, in this order.

1. toxicity      rows that the classifier chain judges toxic go
2. quality       rows that the compression classifier predicts 0 go
3. near_dedup    one row of each group of near-duplicates (0.8) stays
4. mixing        a seeded token-prefix of each domain/language/source leaf,
                 90 % of the tokens left, by target weights, at most one epoch
                 (a second would bring back copies that stage 3 removed)
5. sentencepiece token ids of every text that is left

Models are fitted on the labelled rows of the input tables, not on what earlier
stages kept, so a stage decides the same about a text wherever it stands.  All
stages but the last return rows of ``documents`` with its columns; empty tables
pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import compress_quality, dart_minhash, mixing, sentencepiece_scan
from tidewater.llm import toxicity as toxicity_chain
from tidewater.llm.base import prepare, stored, table

MIX_SHARE = 0.9


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    chain = toxicity_chain.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity_chain.drop_toxic(docs, chain)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return compress_quality.keep_good(docs, compress_quality.fit(table(spark, sf_dir, "documents"),
                                                                 table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dart_minhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.select_mix(docs, budget_share=MIX_SHARE, max_epochs=1)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sentencepiece_scan.encode_documents(docs, sentencepiece_scan.load_model())


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_dedup", near_dedup), ("mixing", mix),
          ("sentencepiece", sentencepiece)]
#: The stages use learned models and compression; no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
