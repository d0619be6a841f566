"""Checked, paged append of a table to a relational database."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Default paging of the export.
ROWS_PER_PAGE = 100_000
MAX_PAGES = 8
BATCH_SIZE = 10_000


def schema_differences(source: StructType, target: StructType) -> list[str]:
    """What keeps `source` from being appended to `target`, column by column."""
    ours = {f.name: f.dataType.simpleString() for f in source.fields}
    theirs = {f.name: f.dataType.simpleString() for f in target.fields}
    found = [f"{c}: not in the source" for c in theirs if c not in ours]
    found += [f"{c}: not in the target" for c in ours if c not in theirs]
    shared = [c for c in theirs if c in ours]
    found += [f"{c}: {ours[c]} for {theirs[c]}" for c in shared if ours[c] != theirs[c]]
    places = [c for c in ours if c in theirs]
    found += [f"{a}: in the place of {b}" for a, b in zip(places, shared, strict=True) if a != b]
    return found


def verify_schema(source: StructType, target: StructType) -> None:
    """Columns must agree in name, type and order."""
    if found := schema_differences(source, target):
        raise ValueError("the columns do not match: " + "; ".join(found))


def page_count(
    rows: int,
    rows_per_page: int = ROWS_PER_PAGE,
    max_pages: int = MAX_PAGES,
    paged: bool = True,
) -> int:
    if not paged:
        return 1
    return max(1, min(max_pages, math.ceil(rows / rows_per_page)))


def page_plan(
    counts: DataFrame, rows_per_page: int = ROWS_PER_PAGE, max_pages: int = MAX_PAGES
) -> DataFrame:
    """`counts` with a column rows -> the same with the number of pages."""
    pages = F.ceil(F.col("rows") / rows_per_page)
    return counts.withColumn(
        "pages", F.greatest(F.lit(1), F.least(F.lit(max_pages), pages)).cast("long")
    )


def target_schema(
    spark: SparkSession, url: str, table: str, options: Mapping[str, str]
) -> StructType:
    reader = spark.read.format("jdbc").options(**options)
    return reader.option("url", url).option("dbtable", table).load().limit(0).schema


def append_pages(
    df: DataFrame,
    url: str,
    table: str,
    options: Mapping[str, str],
    pages: int,
    batch_size: int = BATCH_SIZE,
) -> None:
    """One connection per page; the repartition evens out the pages."""
    (
        df.repartition(pages)
        .write.format("jdbc")
        .options(**options)
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )


def export_table(
    df: DataFrame,
    url: str,
    table: str,
    options: Mapping[str, str],
    rows_per_page: int = ROWS_PER_PAGE,
    max_pages: int = MAX_PAGES,
    batch_size: int = BATCH_SIZE,
    paged: bool = True,
) -> None:
    """Append `df` to an existing table after checking that the schemas agree.

    `options` carries the driver, user and password, and driver-specific settings.
    """
    verify_schema(df.schema, target_schema(df.sparkSession, url, table, options))
    pages = page_count(df.count(), rows_per_page, max_pages) if paged else 1
    append_pages(df, url, table, options, pages, batch_size)
