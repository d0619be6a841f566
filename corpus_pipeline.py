"""Raw documents to packed training sequences, in five stages.

Each stage gets the documents that the one before kept and returns the columns of `documents`; the last returns the
pieces of the packed sequences. `run` writes every stage to the folder that the cluster shares and reads it
back, so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportstar.llm import cotraining, exact_dedup, mixing, near_dedup, packing, queries
from reportstar.sinks.store import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that co-training does not reject."""
    model = cotraining.fit_quality(docs, queries.table(spark, sf_dir, "labels"))
    scored = cotraining.score_quality(docs, model)
    return scored.filter(F.col("p_good") >= queries.GOOD).select("record.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document with the smallest id. Documents without an id stay."""
    groups = near_dedup.near_groups(docs)
    losers = groups.filter("id <> class_id").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(losers, "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: every document once, those of small sources up to twice."""
    return mixing.mix_sources(docs, repeat_limit=2.0).select("record.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens."""
    return packing.pack(docs, queries.byte_bpe)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("source mixing", mix),
    ("packing", pack),
]
# A fitted classifier decides what the first stage keeps, and the tokens come from a tokenizer: no SQL for these.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
