"""Append the whole star to the consumer's database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from reportstar.plans.pipeline import Star
from reportstar.sinks import jdbc
from reportstar.sinks.contracts import CONTRACTS, GENERATED, conform, overlong_keys


def written_columns(name: str, target: StructType) -> StructType:
    """Columns of the target that an export fills: all but those that it generates itself."""
    return StructType([f for f in target.fields if f.name not in GENERATED.get(name, ())])


def export_star(
    star: Star,
    url: str,
    options: Mapping[str, str],
    rows_per_page: int = jdbc.ROWS_PER_PAGE,
    max_pages: int = jdbc.MAX_PAGES,
    batch_size: int = jdbc.BATCH_SIZE,
) -> dict[str, int]:
    """Every table under contract, cast, checked and appended in pages; pages by table. All
    tables are checked before the first is written."""
    spark = star["fact_report"].sparkSession
    ready: dict[str, DataFrame] = {}
    for name, contract in CONTRACTS.items():
        frame = conform(star[name], contract)
        target = jdbc.target_schema(spark, url, name, options)
        if found := jdbc.schema_differences(frame.schema, written_columns(name, target)):
            raise ValueError(f"{name}: " + "; ".join(found))
        if long := [r["column"] for r in overlong_keys(frame).collect()]:
            raise ValueError(f"{name}: keys too long for the consumer in {', '.join(long)}")
        ready[name] = frame
    pages = {}
    for name, frame in ready.items():
        pages[name] = jdbc.page_count(frame.count(), rows_per_page, max_pages)
        jdbc.append_pages(frame, url, name, options, pages[name], batch_size)
    return pages
