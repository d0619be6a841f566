"""Exact deduplication as a stateful stream.

A narrow feed (digest, id, locator) is streamed through a keyed aggregation whose state is kept on disk by
RocksDB under the checkpoint folder and never expires: digest -> latest keeper, its locator, rows seen. Hits are
digests with more than one row; their full bytes are compared before the state is believed, and texts that only
share a digest are told apart by content.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportstar.sinks.store import cut_lineage, shared_folder

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# The disk-backed store, its memory bound per executor, and change logs instead of whole snapshots.
STATE_SETTINGS = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Fixed value: no preallocated files, which cost 4 MB of disk for each state partition.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def seen_digests(feed: DataFrame, files_per_batch: int) -> DataFrame:
    """State of the stream over `feed` (digest, id, locator): digest, keep_id, keep_locator, seen."""
    spark = feed.sparkSession
    folder = f"{shared_folder(spark)}/exact-{uuid.uuid4().hex}"
    feed.write.parquet(f"{folder}/feed")
    stream = (
        spark.readStream.schema(feed.schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{folder}/feed")
        .groupBy("digest")
        .agg(F.max(F.struct("id", "locator")).alias("keeper"), F.count("*").alias("seen"))
    )
    with _settings(spark, STATE_SETTINGS):
        (
            stream.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", f"{folder}/state")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
        state = spark.read.format("statestore").load(f"{folder}/state")
        keeper, seen = (F.col(f"value.`{f.name}`") for f in state.schema["value"].dataType.fields)
        kept = state.select(
            F.col("key.digest").alias("digest"),
            keeper["id"].alias("keep_id"),
            keeper["locator"].alias("keep_locator"),
            seen.alias("seen"),
        )
        return cut_lineage(kept)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int = 10_000,
) -> DataFrame:
    """One row per row of `docs`: id, digest, keep_id, keep_locator, group_size, kept.

    Of equal texts the row with the largest id stays. Null texts are empty texts. Rows equal in text and id
    are repeats of one document: they share keep_id and all say kept (a caller that wants one row of them takes
    one of each id). Null ids lose to every other id; a group of null ids only keeps keep_id null and says
    kept. No rows: no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # A locator tells where the bytes are: the file of the row, or nothing for rows that come from no file.
    locator = F.input_file_name()
    named = docs.select(
        F.col(id_col).cast("long").alias("id"), digest(text).alias("digest"), text.alias("text")
    )
    feed = docs.select(
        digest(text).alias("digest"), F.col(id_col).cast("long").alias("id"), locator.alias("locator")
    )
    state = seen_digests(feed, files_per_batch)
    hits = named.join(state.filter("seen > 1").select("digest"), "digest", "left_semi")
    contents = hits.groupBy("digest", "text").agg(F.max("id").alias("own_id"), F.count("*").alias("own"))
    shared = contents.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1")
    unlike = cut_lineage(contents.join(shared.select("digest"), "digest", "left_semi"))
    found = named.select("id", "digest").join(state, "digest")
    if not unlike.isEmpty():
        collided = unlike.select("digest").distinct()
        apart = (
            named.join(unlike, ["digest", "text"])
            .join(state.select("digest", "keep_locator"), "digest")
            .select("id", "digest", F.col("own_id").alias("keep_id"), "keep_locator", F.col("own").alias("seen"))
        )
        found = found.join(collided, "digest", "left_anti").select(apart.columns).unionByName(apart)
    return found.select(
        "id",
        "digest",
        "keep_id",
        "keep_locator",
        F.col("seen").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay: one of each group of equal texts, with all its columns."""
    kept = (
        exact_groups(docs, id_col, text_col)
        .filter("kept")
        .groupBy("digest", "id")
        .agg((F.count("*") > 1).alias("repeated"))
    )
    kept = cut_lineage(kept)
    digest = sha256(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record"),
        digest.alias("digest"),
        F.col(id_col).cast("long").alias("row_id"),
    )
    staying = rows.join(kept, ["digest"]).filter(F.col("row_id").eqNullSafe(F.col("id")))
    once = staying.filter("NOT repeated").select("record.*")
    if kept.filter("repeated").isEmpty():
        return once
    again = staying.filter("repeated").groupBy("digest").agg(F.first("record").alias("record"))
    return once.unionByName(again.select("record.*"))
