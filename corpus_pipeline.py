"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on all rows that the stage before it kept, and returns the
columns of documents with texts and n_chars as they now are; the last one returns
the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm import decontam, jaccard, packing, repeats, toxicity
from pairforge.llm.common import ship, stored, table

#: Repeats of this many bytes go: some 40 words, so that passages of 50 do.
REPEAT_BYTES = 200


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more for toxicity go."""
    ship(spark)
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, threshold=0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: five words, similarity 0.8 or more."""
    ship(spark)
    return jaccard.one_of_each_class(docs, words=5, threshold=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand elsewhere are taken out of the texts."""
    ship(spark)
    return _counted(repeats.texts_without_repeats(docs, REPEAT_BYTES))


def cut_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are taken out of the texts."""
    ship(spark)
    return _counted(decontam.texts_without_hits(docs, table(spark, sf_dir, "benchmark"), window=10))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences of at most 2048 tokens."""
    ship(spark)
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeats),
    ("benchmark passages", cut_benchmarks),
    ("packing", pack),
]

#: A fitted model, set similarity, tokenization and packing can't be written in
#: SQL; the tests hold each stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs)
    return docs
