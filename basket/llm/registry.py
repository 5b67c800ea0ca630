"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basket.llm import (
    chat, decontam, filter_audit, harmonic, hilbert, langid, ngram_join, packing, records, resampling, rules, toxicity, urls,
)
from basket.llm.common import shared_folder, table

#: The host rules of op5: (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_folder(spark, "records")
    path = public_tokenizers.path("word_bpe_49k.json")
    records.write_records(table(spark, sf_dir, "documents"), out, path, pieces="dropped", end_id=2, vocabulary=49_408)
    back = records.read_records(spark, out)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"), "shard")


def op2_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.filter(~held))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op3_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    columns = "conv_id long, turn long, role string, text string"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], columns)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = shared_folder(spark, "chat")
    chat.build(rows).write(out)
    return chat.digests(chat.PrefixTrees.read(spark, out))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"))


def op5_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack(table(spark, sf_dir, "documents"), path, pieces="leading", end_id=0, capacity=2048)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = toxicity.held_out(F.col("doc_id"))
    classifier = toxicity.train_joined(docs.filter(~held), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = classifier.score(docs)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held.alias("held_out"), "score", predicted)


def op8_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.assign(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~rules.passes("base-1")).alias("base_failed"),
        rules.passes("full-1").alias("kept"),
        "failures",
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontam.find_hits(docs, table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        decontam.is_contaminated().alias("contaminated"),
    )


def op11_harmonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = harmonic.pack(table(spark, sf_dir, "documents"), path, pieces="dropped", end_id=1, capacity=2048)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    drawn = resampling.resample(docs.select("doc_id", "text"), target, buckets=10_000, seed=2024, least=20, percent=10)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_records": op1_records,
        "op2_cross_parsing": op2_cross_parsing,
        "op3_prefix_tree": op3_prefix_tree,
        "op4_ngram_join": op4_ngram_join,
        "op5_link_trust": op5_link_trust,
        "op6_best_fit": op6_best_fit,
        "op7_toxicity": op7_toxicity,
        "op8_hilbert": op8_hilbert,
        "op9_rule_ledger": op9_rule_ledger,
        "op10_decontaminate": op10_decontaminate,
        "op11_harmonic": op11_harmonic,
        "op12_resampling": op12_resampling,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    from basket.llm import sql

    return sql.ORACLES
