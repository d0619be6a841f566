"""Sums over the many-to-many link between reports and members.

Reports that name the same set share a group key, so what a query needs from the reports is
first summed up per group key (with map-side combine, so hot keys cost nothing) and only
then joined with the members. The fan-out of reports x members never exists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportstar.functions.sets import key_bytes
from reportstar.sinks.store import cut_lineage


def rows_per_set(reports: DataFrame, keys: Sequence[str], measures: Sequence[str] = ()):
    return reports.groupBy(*keys).agg(
        F.count("*").alias("reports"), *(F.sum(m).alias(m) for m in measures)
    )


def split_ids(
    reports: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame | None]:
    """(distinct ids per combination of `keys`, for ids with one combination only), and the distinct (report_id, keys)
    of the others; None if there are none. A NULL id is no id.

    The ids in several sets are written first: the join that picks them out then reads plain exchanges on both
    sides, and an id that many sets share can be split.
    """
    pairs = reports.filter(F.col("report_id").isNotNull()).select("report_id", *keys).distinct()
    several = cut_lineage(
        pairs.groupBy("report_id").count().filter(F.col("count") > 1).select("report_id")
    )
    if several.isEmpty():
        return pairs.groupBy(*keys).agg(F.count("*").alias("ids")), None
    alone = pairs.join(several, "report_id", "left_anti")
    return (
        alone.groupBy(*keys).agg(F.count("*").alias("ids")),
        pairs.join(several, "report_id", "left_semi"),
    )


def summarize_reports_by(
    reports: DataFrame,
    key: str,
    members: DataFrame,
    by: Sequence[str],
    unique_report_ids: bool,
    measures: Sequence[str] = (),
) -> DataFrame:
    """Per `by`, over reports x members on the group key:

    reports      distinct report ids
    member_rows  rows of the joined view
    share        sum of weight_factor, the fair-share count
    measures     sums of the given report columns, once per joined row

    An id that occurs with one set only is counted with its set; only ids in several sets meet the members one by
    one. `unique_report_ids` says that there are no such ids and saves looking for them.

    Members are dealt once, by the set alone: rows of a set are few, and their sums and the join with the reports find
    them together.
    """
    reports, members = (df.withColumn(key, key_bytes(F.col(key))) for df in (reports, members))
    named = members.select(key, *by, "weight_factor").repartition(key).groupBy(key, *by).agg(
        F.count("*").alias("_rows"), F.sum("weight_factor").alias("_weight")
    )
    sets = rows_per_set(reports, [key], measures)
    several = None
    if unique_report_ids:
        sets = sets.withColumn("ids", F.col("reports"))
    else:
        alone, several = split_ids(reports, [key])
        sets = sets.join(alone, key, "left")
    parts = sets.join(named, key).select(
        *by,
        F.coalesce("ids", F.lit(0)).alias("reports"),
        (F.col("_rows") * F.col("reports")).alias("member_rows"),
        (F.col("_weight") * F.col("reports")).alias("share"),
        *((F.col("_rows") * F.col(m)).alias(m) for m in measures),
    )
    if several is not None:
        met = several.join(members.select(key, *by), key).select(*by, "report_id").distinct()
        parts = parts.unionByName(
            met.select(*by, F.lit(1).cast("long").alias("reports")), allowMissingColumns=True
        )
    return parts.groupBy(*by).agg(
        *(F.sum(c).alias(c) for c in ("reports", "member_rows", "share", *measures))
    )
