"""Member sets to weighted bridge rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN_ID = -1


def unknown_if_null(column: str):
    return F.coalesce(F.col(column), F.lit(UNKNOWN_ID).cast("long"))


def with_weights(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Members per set and the even share of each. The window holds one set at a time,
    which is as long as one list in one source row."""
    return (
        df.withColumn("member_count", F.count("*").over(Window.partitionBy(*keys)))
        .withColumn("weight_factor", F.lit(1.0) / F.col("member_count"))
        .withColumn("is_unknown_member", F.col(id_col) == UNKNOWN_ID)
    )


def resolve_members(
    reports: DataFrame, key: str, members: str, lookup: DataFrame, id_col: str
) -> DataFrame:
    """One row per (set, resolved id), weights adding up to 1 per set.

    `lookup` is (member, `id_col`). Equal sets are merged, map-side first, before they are
    exploded, so a set that a third of all reports share is one row from here on. Unresolved
    members of a set collapse into one unknown row that keeps the smallest of them, and so
    do members that resolve to the same id.

    Distinct pairs of key and set are hashed; taking the first set of a key would sort all
    reports, as a list cannot be changed in place.

    The collapse is a window over the set and not a groupBy(set, id): both windows then
    need the rows by set only, which is how the merge left them if `lookup` is broadcast,
    and one exchange away if it is not.
    """
    return resolve_sets(reports.select(key, members).distinct(), key, members, lookup, id_col)


def resolve_sets(sets: DataFrame, key: str, members: str, lookup: DataFrame, id_col: str) -> DataFrame:
    """The same for sets that are distinct already."""
    resolved = (
        sets.select(key, F.explode(members).alias("member"))
        .join(lookup, "member", "left")
        .select(key, unknown_if_null(id_col).alias(id_col), "member")
    )
    in_set = Window.partitionBy(key).orderBy(id_col, "member")
    collapsed = (
        resolved.withColumn("_previous", F.lag(id_col).over(in_set))
        .filter(~F.col("_previous").eqNullSafe(F.col(id_col)))
        .select(key, id_col, F.col("member").alias("member_value"))
    )
    return with_weights(collapsed, [key], id_col)
