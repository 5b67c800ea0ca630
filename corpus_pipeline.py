"""A corpus pipeline over ``documents``: language, quality, near duplicates, benchmark passages, packing.

Each stage is a function of (spark, docs, sf_dir) over everything that the stage before it kept, and calls
one operator of ``basket.llm``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basket.llm import decontam, langid, ngram_join, packing, rules
from basket.llm.common import shared_folder, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cross-parsing can tell; learned from the stage's own labelled documents."""
    return langid.keep_identified(docs, langid.train(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the full rule policy."""
    return rules.apply_policy(docs, "full-1")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies."""
    return ngram_join.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``, stray passages cut out."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens packed into sequences of 2,048: one row per piece."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack(docs, path, pieces="leading", end_id=0, capacity=2048, remembered=200_000)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Language identification, MinHash banding and tokenization have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet to the shared folder and read again."""
    out = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
    return docs
