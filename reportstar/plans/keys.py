"""The surrogate-key registry: append-only, an id stays with its value over all runs."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.functions.sets import UNKNOWN
from reportstar.operators.numbering import number_rows
from reportstar.sinks.store import cut_lineage

# Dimension -> label column of the staged reports.
REPORT_LABELS = {
    "classification": "classification_name",
    "evidence_type": "evidence_type_name",
    "importance_level": "importance_level",
    "source": "source_name",
    "threat_type": "threat_type_name",
}
LABEL_DIMENSIONS = (*REPORT_LABELS, "country")


def key_candidates(
    stg_report: DataFrame, stg_adversary: DataFrame, stg_entity: DataFrame
) -> DataFrame:
    """(dimension, natural_key, label) of every value seen; the label is the smallest
    spelling.

    Each branch scans only its own columns. Labels are made distinct before min(), which on
    text needs a sort: the sort then sees distinct labels and not one row per report and
    label.
    """

    def candidates(df: DataFrame, dimension: str, label: Column) -> DataFrame:
        return df.select(F.lit(dimension).alias("dimension"), label.alias("label"))

    report_labels = F.array(
        *(
            F.struct(F.lit(dimension).alias("dimension"), F.col(column).alias("label"))
            for dimension, column in REPORT_LABELS.items()
        )
    )
    seen = (
        stg_report.select(F.explode(report_labels).alias("entry"))
        .select("entry.*")
        .unionByName(candidates(stg_report, "country", F.explode("country_labels")))
        .unionByName(candidates(stg_adversary, "country", F.explode("country_members")))
        .unionByName(candidates(stg_adversary, "adversary", F.col("adversary_id")))
        .unionByName(candidates(stg_entity, "entity", F.col("entity_natural_key")))
        .filter(F.col("label").isNotNull())
        .distinct()
    )
    natural_key = F.upper("label")
    # A real value 'Unknown' must not stand beside the unknown member of its dimension.
    is_unknown = F.col("dimension").isin(*LABEL_DIMENSIONS) & (natural_key == UNKNOWN)
    return (
        seen.filter(~is_unknown)
        .groupBy("dimension", natural_key.alias("natural_key"))
        .agg(F.min("label").alias("label"))
    )


def register(
    candidates: DataFrame,
    existing: DataFrame | None,
    first_seen_at: datetime,
    cut: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> DataFrame:
    """The registry rows to append: keys not seen before, numbered on from the highest id of
    their dimension in the order of the natural key. Known keys and labels never change."""
    unseen = candidates
    if existing is not None:
        unseen = candidates.join(
            existing.select("dimension", "natural_key"), ["dimension", "natural_key"], "left_anti"
        )
    numbered = number_rows(unseen, ["natural_key"], "id", within="dimension", cut=cut)
    if existing is not None:
        # One row per dimension, and there are eight dimensions.
        high_water = existing.groupBy("dimension").agg(F.max("id").alias("max_id"))
        numbered = numbered.join(F.broadcast(high_water), "dimension", "left").withColumn(
            "id", F.col("id") + F.coalesce("max_id", F.lit(0))
        )
    return numbered.select(
        "dimension",
        "natural_key",
        "label",
        F.col("id").cast("long").alias("id"),
        F.lit(first_seen_at).alias("first_seen_at"),
    )
