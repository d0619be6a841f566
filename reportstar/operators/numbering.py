"""Gap-free numbering without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportstar.sinks.store import cut_lineage

# monotonically_increasing_id() puts the partition number above these bits.
_POSITION_BITS = 33


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    id_col: str,
    within: str | None = None,
    cut: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> DataFrame:
    """1..n in the order of `order_by` (NULLs first), restarted for every value of `within`.

    The rows are range-partitioned and sorted in place, so every partition knows the local
    position of its rows. What the partitions need from each other is one row count per
    (partition, `within`) and that is all that is broadcast: at most the number of shuffle
    partitions plus the number of `within` values, never more with more data. `within`
    must have few values (it names a dimension). The columns of `order_by` together must
    be unique, or nearly, so that no hot value has to stay in one range.

    `cut` writes its argument where all executors can read it, and reads it back.
    """
    group = [within] if within else []
    keys = [*group, *order_by]
    # Written before it is counted: both passes must see the very same partitions.
    placed = cut(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_position", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_position", _POSITION_BITS))

    spans = placed.groupBy("_part", *group).agg(
        F.min("_position").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = (
        Window.partitionBy(*group)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = spans.select(
        "_part",
        *group,
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return placed.join(F.broadcast(shifts), ["_part", *group]).select(
        *df.columns, (F.col("_position") + F.col("_shift") + 1).alias(id_col)
    )
