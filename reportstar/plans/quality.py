"""The promises of the model, checked.

Rates and ages come from what the build observed while it wrote. All other checks count keys first
(map-side) and compare the counts, so none of them joins report rows with report rows.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportstar.functions.sets import key_bytes
from reportstar.operators.counting import rows_per_set
from reportstar.plans import measures
from reportstar.plans.keys import REPORT_LABELS
from reportstar.plans.pipeline import LABEL_DIM_TABLES, Star
from reportstar.plans.views import (
    adversary_members,
    country_members,
    entity_members,
    group_members,
    metric_rows,
)
from reportstar.sinks.store import cut_lineage

WEIGHT_TOLERANCE = 1e-9

DIMENSIONS = (*LABEL_DIM_TABLES.values(), "dim_adversary", "dim_entity")

# Bridge -> (set key, dimension id, dimension).
REPORT_BRIDGES = {
    "bridge_country": ("country_group_key", "country_id", "dim_country"),
    "bridge_entity": ("entity_group_key", "entity_id", "dim_entity"),
    "bridge_group_adversary": ("group_group_key", "adversary_dim_id", "dim_adversary"),
    "bridge_adversary": ("adversary_group_key", "adversary_dim_id", "dim_adversary"),
}

MEMBER_VIEWS = {
    "vw_report_country": (country_members, "country_group_key"),
    "vw_report_entity": (entity_members, "entity_group_key"),
    "vw_report_group": (group_members, "group_group_key"),
    "vw_report_adversary": (adversary_members, "adversary_group_key"),
}

UNIQUE_KEYS = {
    "fact_report": ["report_id"],
    "dim_key": ["dimension", "natural_key"],
    **{name: ["id"] for name in DIMENSIONS},
    **{name: [key, fk] for name, (key, fk, _) in REPORT_BRIDGES.items()},
    "bridge_adversary_country": ["adversary_id", "member_value"],
}


def stack(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def measured(star: Star) -> DataFrame:
    """What the build observed while it wrote; a star that was stored without it is scanned."""
    return measures.scanned(star.tables) if star.measures is None else star.measures


def coverage_rates(star: Star) -> DataFrame:
    counts = measures.per_relation(measured(star), "known", "registered", "with_alt_id")
    return metric_rows(
        counts.select(
            F.round(F.try_divide("registered", "known"), 6).alias("registered_share"),
            F.round(F.try_divide("with_alt_id", "registered"), 6).alias("alt_id_share"),
        )
    )


def unknown_rates(star: Star) -> DataFrame:
    return measures.per_relation(measured(star), "members", "unknown_members").select(
        F.col("relation").alias("bridge"),
        "members",
        "unknown_members",
        F.round(F.try_divide("unknown_members", "members"), 6).alias("unknown_rate"),
    )


def freshness(star: Star, now: datetime) -> DataFrame:
    """Age of the last refresh and of the newest member of every dimension, and of the last
    report update in the fact."""
    return ages(measured(star), now)


def ages(observed: DataFrame, now: datetime) -> DataFrame:
    moment = F.unix_timestamp(F.lit(now))
    return measures.per_relation(observed, "refreshed", "newest", "newest_known").select(
        F.col("relation").alias("table"),
        (moment - F.col("refreshed")).alias("refresh_age_seconds"),
        (moment - F.coalesce("newest_known", "newest")).alias("newest_age_seconds"),
    )


def _pairs(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(relation, key) for several columns of a table in one pass."""
    return df.select(
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(relation).alias("relation"), F.col(c).cast("string").alias("key")
                    )
                    for relation, c in columns.items()
                )
            )
        ).alias("pair")
    ).select("pair.*")


def referential(star: Star) -> DataFrame:
    """Per reference: NULL keys, and rows whose key its target does not have.

    Keys are counted before they meet their targets, so a key shared by many rows is one
    row, and all references are checked in one join.
    """
    fact_keys: dict[str, str] = {f"fact_report.{d}_id": f"{d}_id" for d in REPORT_LABELS}
    used, targets = [], []
    for d in REPORT_LABELS:
        targets.append(_pairs(star[LABEL_DIM_TABLES[d]], {f"fact_report.{d}_id": "id"}))
    bridges = {**REPORT_BRIDGES, "bridge_adversary_country": (None, "country_id", "dim_country")}
    for name, (key, fk, dim) in bridges.items():
        used.append(_pairs(star[name], {f"{name}.{fk}": fk}))
        targets.append(_pairs(star[dim], {f"{name}.{fk}": "id"}))
        if key:
            fact_keys[f"fact_report.{key}"] = key
            targets.append(_pairs(star[name], {f"fact_report.{key}": key}))
    used.append(_pairs(star.reports, fact_keys))

    relations = [*fact_keys, *(f"{name}.{fk}" for name, (_, fk, _) in bridges.items())]
    none_yet = star.reports.sparkSession.range(1).select(
        F.explode(F.array(*(F.lit(r) for r in relations))).alias("relation"),
        F.lit(None).cast("string").alias("key"),
        F.lit(0).cast("long").alias("count"),
    )
    counts = stack(used).groupBy("relation", "key").count().unionByName(none_yet)
    there = stack(targets).distinct().withColumn("there", F.lit(True))
    rows = F.col("count")
    no_key = F.col("key").isNull()
    return (
        counts.join(there, ["relation", "key"], "left")
        .groupBy("relation")
        .agg(
            F.sum(F.when(no_key, rows).otherwise(0)).alias("null_keys"),
            F.sum(F.when(~no_key & F.col("there").isNull(), rows).otherwise(0)).alias(
                "orphan_rows"
            ),
        )
    )


def _keyed(df: DataFrame, key: str) -> DataFrame:
    """Half of what a key by text would take to be counted elsewhere."""
    return df.withColumn(key, key_bytes(F.col(key)))


def weight_sums(star: Star) -> DataFrame:
    """Reports whose weights do not add up to 1, per bridge and as the views show them: a
    dimension row that is missing or repeated counts too."""
    checks = []
    for name, (key, fk, dim) in REPORT_BRIDGES.items():
        shown = star[name].join(star[dim].select(F.col("id").alias(fk)), fk)
        weights = _keyed(shown, key).groupBy(key).agg(F.sum("weight_factor").alias("total"))
        off = F.col("total").isNull() | (F.abs(F.col("total") - 1) > WEIGHT_TOLERANCE)
        checks.append(
            rows_per_set(_keyed(star.reports, key), [key])
            .join(weights, key, "left")
            .agg(
                F.lit(name).alias("bridge"),
                F.sum("reports").alias("reports"),
                F.sum(F.when(off, F.col("reports")).otherwise(0)).alias("reports_off"),
                F.round(F.min("total"), 6).alias("min_total"),
                F.round(F.max("total"), 6).alias("max_total"),
            )
        )
    return stack(checks)


def _rows_in_doubt(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key may occur twice, and so all whose key does: those that share the 8 bytes of a hash with another.
    Hashes are counted first, and written, so that of the rows of one relation at a time no more is dealt."""
    hashed = rows.withColumn("_hash", F.xxhash64(*keys))
    shared = cut_lineage(hashed.groupBy("_hash").count().filter(F.col("count") > 1).select("_hash"))
    return hashed.join(shared, "_hash", "left_semi")


def uniqueness(star: Star) -> DataFrame:
    set_key = {name: key for name, (key, _, _) in REPORT_BRIDGES.items()}
    return stack(
        [
            _rows_in_doubt(_keyed(star[name], set_key[name]) if name in set_key else star[name], keys)
            .groupBy(*keys)
            .count()
            .agg(
                F.lit(name).alias("relation"),
                F.lit(",".join(keys)).alias("key"),
                F.count_if(F.col("count") > 1).alias("repeated_keys"),
                F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("extra_rows"),
            )
            for name, keys in UNIQUE_KEYS.items()
        ]
    )


def member_coverage(star: Star) -> DataFrame:
    """Reports that a member view does not show; the promise is none."""
    checks = []
    for view, (members_of, key) in MEMBER_VIEWS.items():
        shown = members_of(star).select(key, F.lit(True).alias("shown")).distinct()
        checks.append(
            rows_per_set(star.reports, [key])
            .join(shown, key, "left")
            .agg(
                F.lit(view).alias("view"),
                F.sum("reports").alias("reports"),
                F.sum(F.when(F.col("shown").isNull(), F.col("reports")).otherwise(0)).alias(
                    "missing_reports"
                ),
            )
        )
    return stack(checks)
