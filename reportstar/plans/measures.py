"""Numbers about tables, observed while the tables are written.

A build attaches them to the write of a table, so they cost no scan, and stores them beside the star as
(relation, measure, value). Moments are seconds since the epoch. `scanned` finds the same numbers in stored tables.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportstar.operators.bridging import UNKNOWN_ID
from reportstar.plans.dims import LABEL_COLUMNS

SCHEMA = "relation string, measure string, value long"

MEMBER_BRIDGES = (
    "bridge_country",
    "bridge_entity",
    "bridge_group_adversary",
    "bridge_adversary",
    "bridge_adversary_country",
)


def members() -> dict[str, Column]:
    return {"members": F.count("*"), "unknown_members": F.count_if("is_unknown_member")}


def ages() -> dict[str, Column]:
    """The unknown member is as old as the build and counts only if there is no other."""
    created = F.unix_timestamp("created_at")
    return {
        "refreshed": F.max(F.unix_timestamp("updated_at")),
        "newest_known": F.max(F.when(F.col("id") != UNKNOWN_ID, created)),
        "newest": F.max(created),
    }


def entities() -> dict[str, Column]:
    known = F.col("id") != UNKNOWN_ID
    registered = known & F.col("is_registered")
    return {
        "known": F.count_if(known),
        "registered": F.count_if(registered),
        "with_alt_id": F.count_if(registered & F.col("alt_id").isNotNull()),
        **ages(),
    }


def reports() -> dict[str, Column]:
    return {
        "refreshed": F.max(F.unix_timestamp("updated_at")),
        "newest": F.max(F.unix_timestamp("report_updated_at")),
    }


MEASURES: dict[str, Callable[[], dict[str, Column]]] = {
    **dict.fromkeys(MEMBER_BRIDGES, members),
    **{f"dim_{d}": ages for d in LABEL_COLUMNS},
    "dim_adversary": ages,
    "dim_entity": entities,
    "fact_report": reports,
}

#: Values by measure; NULL where a table has no row to take them from.
Values = Mapping[str, int | None]


def columns(relation: str) -> list[Column]:
    return [value.cast("long").alias(name) for name, value in MEASURES[relation]().items()]


def rows(spark: SparkSession, measured: Mapping[str, Values]) -> DataFrame:
    """Some dozens of numbers, as a table."""
    listed = [(relation, m, value) for relation, values in measured.items() for m, value in values.items()]
    return spark.createDataFrame(listed, SCHEMA).coalesce(1)


def relations_with(measure: str) -> list[str]:
    return [relation for relation, of in MEASURES.items() if measure in of()]


def scanned(tables: Mapping[str, DataFrame], relations: Collection[str] = tuple(MEASURES)) -> DataFrame:
    """The same table, from the stored rows."""
    found = []
    for relation in relations:
        pairs = [
            F.struct(F.lit(name).alias("measure"), F.col(name).alias("value")) for name in MEASURES[relation]()
        ]
        once = tables[relation].agg(*columns(relation))
        found.append(once.select(F.lit(relation).alias("relation"), F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, found)


def per_relation(measured: DataFrame, *names: str) -> DataFrame:
    """One row per relation with its measures as columns; only relations that have the first of them."""
    return (
        measured.filter(F.col("measure").isin(*names))
        .groupBy("relation")
        .agg(
            F.bool_or(F.col("measure") == names[0]).alias("has"),
            *(F.max(F.when(F.col("measure") == n, F.col("value"))).alias(n) for n in names),
        )
        .filter("has")
        .drop("has")
    )
