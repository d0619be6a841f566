"""The dealt operators over the given tables, each under its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportstar.llm import (
    bwt_merge,
    cotraining,
    exact_dedup,
    hard_negatives,
    host_rules,
    merkle,
    mixing,
    near_dedup,
    packing,
    sharding,
    suffix_automaton,
    token_counts,
    topk,
)

SHARDS = 40
GOOD = 0.5
PIECES, RANKS, BYTE_BPE = "piece_bpe_32k.model", "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unigram_pieces():
    import public_tokenizers

    return token_counts.zipf_pieces(public_tokenizers.path(PIECES))


def byte_bpe() -> packing.Encoder:
    import public_tokenizers

    return packing.byte_bpe_encoder(public_tokenizers.path(RANKS), public_tokenizers.path(BYTE_BPE))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), unigram_pieces)
    return counts.withColumnRenamed("id", "doc_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.col("digest").alias("text_sha256"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_bpe, with_tokens=False)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_automaton.remove_repeated_passages(table(spark, sf_dir, "documents"), window=13)
    return cut.select(
        F.col("id").alias("doc_id"),
        F.col("n_units").alias("n_words"),
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = bwt_merge.remove_repeated_bytes(table(spark, sf_dir, "documents"), window=50)
    return cut.select(
        F.col("id").alias("doc_id"),
        F.col("n_units").alias("n_bytes"),
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_dedup.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        "class_id",
        F.col("id").eqNullSafe(F.col("class_id")).alias("kept"),
        "n_copies",
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(
        "record.doc_id", F.col("mix_source").alias("source"), "tokens", "target_tokens", "epoch", "order_key"
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = cotraining.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = cotraining.score_quality(docs, model)
    return scored.select(
        "record.doc_id", "p_content", "p_metadata", "p_good", (F.col("p_good") >= GOOD).alias("kept")
    )


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = sharding.shard_documents(
        docs, SHARDS, payload=[F.col("doc_id"), F.crc32(text.cast("binary")).alias("text_crc32")]
    )
    return placed.select(
        "record.doc_id",
        "size",
        "record.text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate("text", upper, upper.lower())
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    claim = F.when(tampered, merkle.leaf_digest([*values, lowered])).alias("claim")
    proofs = merkle.manifest(docs, carried=[claim])
    claimed = F.coalesce(F.col("carried.claim"), F.col("leaf"))
    return proofs.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof_text(F.col("lefts"), F.col("rights")), 256).alias("proof_sha256"),
        merkle.fold(claimed, F.col("lefts"), F.col("rights")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge_documents(table(spark, sf_dir, "documents"), payload=[F.col("doc_id")])
    return judged.select(
        "record.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "verdict",
        "kept",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_packing": op3_packing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_mixing": op6_mixing,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_quality": op8_quality,
    "op9_exact_topk": op9_exact_topk,
    "op10_sharding": op10_sharding,
    "op11_merkle": op11_merkle,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_host_rules": op13_host_rules,
}
