"""What the consumer of the exported tables expects, and the cast plan that gets there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from reportstar.plans.dims import LABEL_COLUMNS
from reportstar.plans.fact import GROUP_KEYS
from reportstar.plans.keys import REPORT_LABELS
from reportstar.plans.quality import REPORT_BRIDGES

GROUP_KEY_LENGTH = 32

_STAMPS: dict[str, DataType] = {"created_at": TimestampType(), "updated_at": TimestampType()}


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


def _texts(*names: str) -> dict[str, DataType]:
    return dict.fromkeys(names, StringType())


def _bridge(keys: list[str], fk: str) -> StructType:
    return _struct(
        **_texts(*keys),
        **{fk: LongType()},
        member_value=StringType(),
        member_count=IntegerType(),
        weight_factor=DoubleType(),
        is_unknown_member=BooleanType(),
        **_STAMPS,
    )


CONTRACTS: dict[str, StructType] = {
    **{
        f"dim_{d}": _struct(id=LongType(), **_texts(label), **_STAMPS)
        for d, label in LABEL_COLUMNS.items()
    },
    "dim_adversary": _struct(
        id=LongType(), **_texts("adversary_id", "adversary_name", "country_group_key"), **_STAMPS
    ),
    "dim_entity": _struct(
        id=LongType(),
        **_texts(
            "registry_id", "alt_id", "name_en", "name_native",
            "country", "category", "sector", "entity_type", "domain",
        ),
        is_registered=BooleanType(),
        **_STAMPS,
    ),
    "fact_report": _struct(
        id=LongType(),
        **_texts("report_id", "title", "description", "actions", "analysis"),
        **dict.fromkeys(("creation_date", "publication_date", "report_date"), DateType()),
        report_updated_at=TimestampType(),
        **{f"{d}_id": LongType() for d in REPORT_LABELS},
        **_texts(*GROUP_KEYS),
        **_STAMPS,
    ),
    **{name: _bridge([key], fk) for name, (key, fk, _) in REPORT_BRIDGES.items()},
    "bridge_adversary_country": _bridge(["country_group_key", "adversary_id"], "country_id"),
}

# Columns that the consumer's tables number themselves.
GENERATED: dict[str, tuple[str, ...]] = {name: ("id",) for name in CONTRACTS if name.startswith("bridge_")}


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """`df` in the column order and types of the contract. A value that does not fit its
    type raises (ANSI casts); a missing column raises when the plan is analysed."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields))


def overlong_keys(df: DataFrame, length: int = GROUP_KEY_LENGTH) -> DataFrame:
    """(column, rows): group keys longer than the consumer can hold; empty if all fit."""
    keys = [c for c in df.columns if c.endswith("_group_key")]
    if not keys:
        return df.sparkSession.createDataFrame([], "column string, rows long")
    counts = df.agg(*(F.count_if(F.length(c) > length).alias(c) for c in keys))
    return counts.unpivot([], keys, "column", "rows").filter("rows > 0")
