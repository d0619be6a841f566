from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reportstar.plans.pipeline import Star, build_star  # noqa: E402
from reportstar.sinks.store import TableStore  # noqa: E402
from reportstar.sources import RawTables  # noqa: E402
from reportstar.sources.raw import (  # noqa: E402
    ADVERSARY_COLUMNS,
    ENTITY_COLUMNS,
    REPORT_COLUMNS,
)

AS_OF = datetime(2026, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def frame(spark: SparkSession, columns, rows: list[dict]):
    """Text rows; columns that a row does not name are NULL."""
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)


def feeds(spark, reports=(), adversaries=(), entities=()) -> RawTables:
    typed = [{"report_type": "threat", **r} for r in reports]
    return RawTables(
        frame(spark, REPORT_COLUMNS, typed),
        frame(spark, ADVERSARY_COLUMNS, list(adversaries)),
        frame(spark, ENTITY_COLUMNS, list(entities)),
    )


def star_of(spark, store=None, as_of=AS_OF, **rows) -> Star:
    return build_star(feeds(spark, **rows), store or TableStore(spark), as_of)


def rows_of(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
