"""Dimensions: the unknown member (id -1) and one row per registered key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.functions.sets import NO_TARGET
from reportstar.operators.bridging import UNKNOWN_ID
from reportstar.plans.keys import REPORT_LABELS

# The names of the unknown member.
UNKNOWN_LABEL = "Unknown"
UNKNOWN_NATIVE = "غير معروف"

LABEL_COLUMNS = {**REPORT_LABELS, "country": "country_name"}


def _registered(registry: DataFrame, dimension: str) -> DataFrame:
    return registry.filter(F.col("dimension") == dimension)


def _with_unknown(dim: DataFrame, as_of: datetime, **known: Column) -> DataFrame:
    """Put the unknown row on top; columns not given are NULL in it."""
    stamps = {"id": F.lit(UNKNOWN_ID), "created_at": F.lit(as_of), "updated_at": F.lit(as_of)}
    values = {**stamps, **known}
    unknown = dim.sparkSession.range(1).select(
        *(
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in dim.schema.fields
        )
    )
    return unknown.unionByName(dim)


def label_dimension(registry: DataFrame, dimension: str, as_of: datetime) -> DataFrame:
    label = LABEL_COLUMNS[dimension]
    dim = _registered(registry, dimension).select(
        "id",
        F.col("label").alias(label),
        F.col("first_seen_at").alias("created_at"),
        F.lit(as_of).alias("updated_at"),
    )
    return _with_unknown(dim, as_of, **{label: F.lit(UNKNOWN_LABEL)})


def adversary_dimension(
    registry: DataFrame, stg_adversary: DataFrame, as_of: datetime
) -> DataFrame:
    """Attributes are found by exact id, so an adversary whose id is not all upper case keeps
    its registered row without an adversary_id."""
    dim = (
        _registered(registry, "adversary")
        .join(stg_adversary, F.col("natural_key") == F.col("adversary_id"), "left")
        .select(
            "id",
            "adversary_id",
            F.coalesce("adversary", "label").alias("adversary_name"),
            "country_group_key",
            F.col("first_seen_at").alias("created_at"),
            F.lit(as_of).alias("updated_at"),
        )
    )
    return _with_unknown(
        dim,
        as_of,
        adversary_name=F.lit(UNKNOWN_LABEL),
        country_group_key=F.md5(F.lit(NO_TARGET)),
    )


def entity_dimension(registry: DataFrame, stg_entity: DataFrame, as_of: datetime) -> DataFrame:
    """A key whose staged row is gone keeps its row, with the label as both names."""
    dim = (
        _registered(registry, "entity")
        .join(stg_entity, F.col("natural_key") == F.col("entity_natural_key"), "left")
        .select(
            "id",
            "registry_id",
            "alt_id",
            F.coalesce("name_en", "label").alias("name_en"),
            F.coalesce("name_native", "label").alias("name_native"),
            "country",
            "category",
            "sector",
            "entity_type",
            "domain",
            F.coalesce("is_registered", F.lit(False)).alias("is_registered"),
            F.col("first_seen_at").alias("created_at"),
            F.lit(as_of).alias("updated_at"),
        )
    )
    return _with_unknown(
        dim,
        as_of,
        name_en=F.lit(UNKNOWN_LABEL),
        name_native=F.lit(UNKNOWN_NATIVE),
        is_registered=F.lit(False),
    )
