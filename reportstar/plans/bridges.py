"""Bridges between group keys and dimension rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportstar.functions.sets import group_key, packed_key, unpacked_key
from reportstar.operators.bridging import resolve_sets, unknown_if_null, with_weights
from reportstar.plans.staging import DELIMITED

BRIDGE_COLUMNS = ("member_value", "member_count", "weight_factor", "is_unknown_member")


def _stamped(df: DataFrame, as_of: datetime) -> DataFrame:
    return df.withColumns({"created_at": F.lit(as_of), "updated_at": F.lit(as_of)})


def _set_bridge(
    reports: DataFrame, key: str, members: str, lookup: DataFrame, id_col: str, as_of: datetime
) -> DataFrame:
    """Members of the sets that group keys name. Sets are made distinct without their keys, which follow from them and
    travel as bytes afterwards."""
    sets = _distinct_sets(reports, members).select(packed_key(group_key(F.col(members))).alias(key), members)
    rows = resolve_sets(sets, key, members, lookup, id_col)
    return _stamped(rows.withColumn(key, unpacked_key(F.col(key))), as_of)


def _distinct_sets(reports: DataFrame, members: str) -> DataFrame:
    if members not in DELIMITED:
        return reports.select(members).distinct()
    pattern, text = DELIMITED[members]
    sets = reports.select(F.array_join(members, text).alias(members)).distinct()
    return sets.select(F.array_remove(F.split(members, pattern), "").alias(members))


def _country_lookup(dim_country: DataFrame) -> DataFrame:
    return dim_country.select(
        F.upper(F.trim("country_name")).alias("member"), F.col("id").alias("country_id")
    )


def country_bridge(stg_report: DataFrame, dim_country: DataFrame, as_of: datetime) -> DataFrame:
    lookup = _country_lookup(dim_country)
    return _set_bridge(stg_report, "country_group_key", "country_members", lookup, "country_id", as_of)


def entity_lookup(dim_entity: DataFrame) -> DataFrame:
    """(member, entity_id): a member matches registry id, then alternative id, then native
    name, then English name; the smallest id wins within one kind of match.

    One minimum per kind keeps the aggregation on plain numbers, so it is hashed and needs
    no sort.
    """
    kinds = ("registry_id", "alt_id", "name_native", "name_en")
    found = dim_entity.select(
        "id",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(i).alias("kind"), F.upper(F.trim(c)).alias("member"))
                    for i, c in enumerate(kinds)
                )
            )
        ).alias("match"),
    ).select("id", "match.*")
    best = [
        F.min(F.when(F.col("kind") == i, F.col("id"))).alias(c) for i, c in enumerate(kinds)
    ]
    return (
        found.filter(F.col("member") != "")
        .groupBy("member")
        .agg(*best)
        .select("member", F.coalesce(*kinds).alias("entity_id"))
    )


def entity_bridge(stg_report: DataFrame, lookup: DataFrame, as_of: datetime) -> DataFrame:
    return _set_bridge(stg_report, "entity_group_key", "entity_members", lookup, "entity_id", as_of)


def group_bridge(stg_report: DataFrame, dim_adversary: DataFrame, as_of: datetime) -> DataFrame:
    """Groups named in reports, matched to adversary ids without regard to case."""
    lookup = dim_adversary.filter(F.col("adversary_id").isNotNull()).select(
        F.upper(F.trim("adversary_id")).alias("member"), F.col("id").alias("adversary_dim_id")
    )
    return _set_bridge(stg_report, "group_group_key", "group_members", lookup, "adversary_dim_id", as_of)


def adversary_bridge(
    report_adversaries: DataFrame, dim_adversary: DataFrame, as_of: datetime
) -> DataFrame:
    """Adversaries that claim a report, matched by exact id."""
    lookup = dim_adversary.filter(F.col("adversary_id").isNotNull()).select(
        F.col("adversary_id").alias("member"), F.col("id").alias("adversary_dim_id")
    )
    claimed = report_adversaries.filter(F.size("adversary_members") > 0)
    return _set_bridge(
        claimed, "adversary_group_key", "adversary_members", lookup, "adversary_dim_id", as_of
    )


def adversary_country_bridge(
    stg_adversary: DataFrame, dim_country: DataFrame, as_of: datetime
) -> DataFrame:
    """Target countries per adversary. Unresolved values stay apart, each with its share."""
    targets = (
        stg_adversary.select(
            "country_group_key", "adversary_id", F.explode("country_members").alias("member")
        )
        .filter(F.trim("member") != "")
        .distinct()
    )
    rows = targets.join(_country_lookup(dim_country), "member", "left").select(
        "country_group_key",
        "adversary_id",
        unknown_if_null("country_id").alias("country_id"),
        F.col("member").alias("member_value"),
    )
    return _stamped(with_weights(rows, ["adversary_id", "country_group_key"], "country_id"), as_of)
