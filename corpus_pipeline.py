"""From raw documents to packed training sequences, one operator per stage.

Each stage works on all that the one before kept; all but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktide.llm import chosen_path, fingerprints, language, packing, toxicity
from worktide.llm.common import Scratch

TOXIC = 0.5
SIMILAR_PERCENT = 80
#: A text whose two best languages differ by less than this share has no clear language; one of fewer bytes of words has, if it holds more words of one of them.
LEAST_MARGIN, LEAST_BYTES = 0.0004, 400


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter go, and those of any length that fit two languages alike; where no language is given, the found one is filled in."""
    model = language.learn(docs, "doc_id", "text", "lang")
    found = language.identify(docs, model, min_margin=LEAST_MARGIN, min_bytes=LEAST_BYTES, prefix="_found", judge_short=True)
    return found.where("NOT _found_rejected").withColumn("lang", F.coalesce("lang", "_found_pred")).select(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose worst window is likelier toxic than not go."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return toxicity.score(docs, model, out="_toxicity").where(F.col("_toxicity") < TOXIC).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after white space is normalised, the smallest id stays."""
    return fingerprints.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of five-word shingles of 0.8 or more, the smallest id stays."""
    return chosen_path.drop_near_copies(docs, percent=SIMILAR_PERCENT)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of the kept documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", known_language), ("toxicity", not_toxic), ("exact_dedup", without_copies), ("near_dedup", without_near_copies), ("pack", packed),
]

#: Learned models, similarity components and packing have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; every stage is written as Parquet to the shared folder and read again."""
    docs, scratch = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), Scratch(spark)
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs
