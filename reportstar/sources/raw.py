"""The three raw feeds and the columns read from them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the feeds, all of them text.
REPORT_COLUMNS = (
    "id", "report_type", "title", "description", "actions", "analysis",
    "creation_date", "publication_date", "report_date", "updated_at",
    "classification", "evidence_type", "importance", "observation_source", "threat_type",
    "country", "entity_ids", "entity_names", "related_groups",
)
ADVERSARY_COLUMNS = ("adversary_id", "adversary", "report_ids", "targeted_country")
ENTITY_COLUMNS = (
    "registry_id", "alt_id", "name_en", "name_native",
    "country", "category", "sector", "entity_type", "domain",
)


def _conform(df: DataFrame, columns: tuple[str, ...], renames: Mapping[str, str]) -> DataFrame:
    source_of = {ours: theirs for theirs, ours in renames.items()}
    return df.select(*(F.col(source_of.get(c, c)).cast("string").alias(c) for c in columns))


@dataclass(frozen=True)
class RawTables:
    report: DataFrame
    adversary: DataFrame
    entity: DataFrame
    #: The report feed as (rest, texts), two tables that share a first column which names the texts of a report: for
    #: whoever stores them apart, and need not put them beside their report before.
    report_parts: tuple[DataFrame, DataFrame] | None = None
    #: The same in slices which together are the feed, with the key of the texts in place of these: for whoever writes
    #: them one after another, so that the shuffle files of one slice lie on disk at a time.
    report_slices: tuple[tuple[DataFrame, DataFrame], ...] = ()

    @classmethod
    def from_frames(
        cls,
        report: DataFrame,
        adversary: DataFrame,
        entity: DataFrame,
        renames: Mapping[str, Mapping[str, str]] | None = None,
    ) -> RawTables:
        """`renames` maps a feed ('report', 'adversary', 'entity') to {its name: our name}."""
        renames = renames or {}
        return cls(
            _conform(report, REPORT_COLUMNS, renames.get("report", {})),
            _conform(adversary, ADVERSARY_COLUMNS, renames.get("adversary", {})),
            _conform(entity, ENTITY_COLUMNS, renames.get("entity", {})),
        )

    @classmethod
    def from_catalog(
        cls,
        spark: SparkSession,
        report: str,
        adversary: str,
        entity: str,
        renames: Mapping[str, Mapping[str, str]] | None = None,
    ) -> RawTables:
        """From catalog tables (Delta, Iceberg, parquet: whatever the session can read)."""
        return cls.from_frames(
            spark.table(report), spark.table(adversary), spark.table(entity), renames
        )

    @classmethod
    def from_parquet(cls, spark: SparkSession, report: str, adversary: str, entity: str):
        return cls.from_frames(
            spark.read.parquet(report), spark.read.parquet(adversary), spark.read.parquet(entity)
        )


def feed_fingerprint(feed: DataFrame) -> str | None:
    """Changes when a file of the feed does, or what is selected from it: from names, sizes and times of all its files,
    without reading them, and its plan. None for rows that do not come from files."""
    plan = re.sub(r"#\d+L?", "", feed._jdf.queryExecution().optimizedPlan().toString())
    paths = feed.inputFiles()
    if not paths or re.search(r"LocalRelation|LogicalRDD|Range \(", plan):
        return None
    try:
        found = feed.sparkSession.read.format("binaryFile").load(paths)
    except AnalysisException:
        return None  # no plain files
    of_file = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    row = found.agg(F.count("*").alias("n"), F.sum("length").alias("b"), F.bit_xor(of_file).alias("x")).first()
    return f"{row['n']}-{row['b']}-{row['x']}-{hashlib.sha256(plan.encode()).hexdigest()}"
