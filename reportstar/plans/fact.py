"""The report fact: five dimension ids, four group keys, a gap-free id."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportstar.functions.sets import packed_key, unpacked_key
from reportstar.operators.bridging import unknown_if_null
from reportstar.operators.numbering import number_rows
from reportstar.plans.keys import REPORT_LABELS
from reportstar.plans.texts import TEXT_KEY, held, with_texts
from reportstar.sinks.store import cut_lineage

GROUP_KEYS = ("country_group_key", "entity_group_key", "group_group_key", "adversary_group_key")


def packed_keys(df: DataFrame) -> DataFrame:
    """Group keys as bytes, for a shuffle of the rows."""
    return df.withColumns({k: packed_key(F.col(k)) for k in GROUP_KEYS if k in df.columns})


def unpacked_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({k: unpacked_key(F.col(k)) for k in GROUP_KEYS if k in df.columns})


def beside_texts(reports: DataFrame, report_text: DataFrame) -> DataFrame:
    """Reports with their texts in place of the key of these; group keys are bytes on the way."""
    return unpacked_keys(with_texts(packed_keys(reports), report_text)).drop(TEXT_KEY)


def with_row_key(stg_report: DataFrame) -> DataFrame:
    """A unique number per row. It must be written with the rows before it is used."""
    return stg_report.withColumn("row_key", F.monotonically_increasing_id())


def report_fact(
    stg_report: DataFrame,
    report_adversaries: DataFrame,
    label_dims: Mapping[str, DataFrame],
    as_of: datetime,
    cut: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> DataFrame:
    """`stg_report` carries the stored `row_key`, `report_adversaries` is keyed by it, and
    `label_dims` maps dimension -> table.

    Labels are looked up, and rows numbered, on a narrow projection; the wide rows are
    shuffled once, on a key that is unique and so free of skew, whatever the labels and
    report ids look like. Labels match in their exact spelling. Texts come with the rows,
    or their key does if they are stored apart.
    """
    narrow = stg_report.select("row_key", "report_id", *REPORT_LABELS.values())
    for dimension, label in REPORT_LABELS.items():
        dim = label_dims[dimension].select(label, F.col("id").alias(f"{dimension}_id"))
        narrow = narrow.join(dim, label, "left")
    fks = [f"{d}_id" for d in REPORT_LABELS]
    narrow = narrow.select("row_key", "report_id", *(unknown_if_null(c).alias(c) for c in fks))
    numbered = number_rows(narrow, ["report_id", "row_key"], "id", cut=cut)
    adversary_keys = packed_keys(report_adversaries.select("row_key", "adversary_group_key"))
    wide = packed_keys(stg_report).join(numbered.drop("report_id"), "row_key").join(adversary_keys, "row_key")
    return unpacked_keys(wide).select(
        "id",
        "report_id",
        "title",
        *held(stg_report),
        "creation_date",
        "publication_date",
        "report_date",
        F.col("updated_at").alias("report_updated_at"),
        *fks,
        *GROUP_KEYS,
        F.lit(as_of).alias("created_at"),
        F.lit(as_of).alias("updated_at"),
    )
