"""What lies on disk while tables are written: no shuffle files, feeds or keys that nobody reads any more."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from pathlib import Path

import pytest
from conftest import rows_of, star_of
from pyspark.sql import functions as F

import __spark_entry__ as contract
from reportstar.plans import fact, quality, staging, texts
from reportstar.plans.pipeline import load_star
from reportstar.sinks.store import FREES_SHUFFLES, CatalogStore, TableStore, cut_lineage, shuffles_freed
from reportstar.sinks.runs import RunStore
from reportstar.sources import derive_raw_tables, testdata

REPORTS = [
    {"id": "1", "country": "Oman, Iran", "entity_ids": "E1|E2", "related_groups": "A"},
    {"id": "2", "country": "Oman"},
    {"id": "2", "country": "Qatar"},
]


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


@pytest.mark.parametrize("way", ["table", "append", "cut", "run", "catalog"])
def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path, way):
    write = {
        "table": lambda df: TableStore(spark, str(tmp_path)).replace("t", df),
        "append": lambda df: TableStore(spark, str(tmp_path)).append("t", df),
        "cut": cut_lineage,
        "run": lambda df: RunStore(spark, str(tmp_path)).replace("t", df),
        "catalog": lambda df: CatalogStore(spark, "default").replace("disk_t", df),
    }[way]
    before = shuffle_files(spark)
    table = write(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count())
    deadline = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < deadline:
        time.sleep(0.1)
    assert not left and table.count() == 100


def test_the_session_gets_its_setting_back(spark):
    def write(_):
        with shuffles_freed(spark):
            assert spark.conf.get(FREES_SHUFFLES) == "true"
            time.sleep(0.05)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(12)))
    assert spark.conf.get(FREES_SHUFFLES) == "false"
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        write(0)
        assert spark.conf.get(FREES_SHUFFLES) == "true"
    finally:
        spark.conf.unset(FREES_SHUFFLES)


def test_repeated_keys_are_found_among_rows_whose_hash_is_shared(spark):
    """Rows are dealt by their key only if another has its hash."""
    store = TableStore(spark)
    whole = star_of(spark, store, reports=REPORTS)
    doubled = {
        "bridge_country": lambda t: t.unionByName(t).unionByName(t.limit(1)),
        "bridge_entity": lambda t: t.unionByName(t.withColumn("entity_group_key", F.lit(None).cast("string"))),
        "dim_key": lambda t: t.unionByName(t.filter("dimension = 'country'").withColumn("natural_key", F.lit(None))),
    }
    tables = {name: store.replace(f"x_{name}", make(whole[name])) for name, make in doubled.items()}
    star = replace(whole, tables={**whole.tables, **tables})
    found = quality.uniqueness(star)
    assert found._jdf.queryExecution().executedPlan().toString().count("LeftSemi") >= len(quality.UNIQUE_KEYS)
    want = []
    for name, keys in quality.UNIQUE_KEYS.items():
        counts = [r["count"] for r in star[name].groupBy(*keys).count().collect()]
        want.append((name, sum(n > 1 for n in counts), sum(counts) - len(counts)))
    assert rows_of(found, "relation", "repeated_keys", "extra_rows") == sorted(want, key=repr)
    assert {w[0] for w in want if w[1]} >= {"fact_report", "bridge_country", "bridge_entity", "dim_key"}


def test_keys_of_staged_sets_are_made_as_they_are_read(spark):
    store = TableStore(spark)
    star = star_of(spark, store, reports=REPORTS, adversaries=[{"adversary_id": "A", "report_ids": "1|2"}])
    for name in staging.UNKEYED_SETS:
        assert not [c for c in store.read(name).columns if c.endswith("_group_key")]
    for shown in (star, load_star(store)):
        staged = shown["stg_report"].join(shown["stg_report_adversary"].drop("report_id"), "row_key")
        assert rows_of(staged, "title", *fact.GROUP_KEYS) == rows_of(shown["fact_report"], "title", *fact.GROUP_KEYS)
    columns = star["stg_report"].columns
    assert columns[-4:] == ["country_group_key", "entity_group_key", "group_group_key", "row_key"]
    assert staging.with_set_keys("stg_report", star["stg_report"]).columns == columns


@pytest.fixture
def build(spark, monkeypatch):
    monkeypatch.setattr(contract, "_builds", {})
    return contract.build(spark, contract.SMOKE_DIR)


def stored(build) -> set[str]:
    return {p.name for p in Path(build.store.root.removeprefix("file://")).iterdir()}


FEEDS = {"raw_report", "raw_report_text", "raw_adversary", "raw_entity"}


def test_feeds_go_when_staging_is_written_and_come_back_when_shown(spark, build):
    ask = contract.queries()
    assert ask["vw_report"](spark, contract.SMOKE_DIR).count() > 0
    left = stored(build)
    assert not left & FEEDS and not [name for name in left if name.startswith("scratch_")]
    shown = ask["filter_report_type"](spark, contract.SMOKE_DIR)
    assert shown.count() == build.tables["stg_report"].count()
    build.tables["bridge_country"].count()
    assert {"raw_report", "raw_report_text"} <= stored(build) and shown.count() > 0


def test_feeds_that_a_query_has_shown_stay(spark, build):
    shown = contract.queries()["clean_null_words"](spark, contract.SMOKE_DIR)
    assert contract.queries()["vw_report"](spark, contract.SMOKE_DIR).count() > 0
    assert FEEDS - {"raw_entity"} <= stored(build) and shown.count() > 0


def test_reports_are_written_in_slices_that_are_the_feed(spark, monkeypatch):
    """As many as the lines need, no more than the most; a slice deals its own orders and lines, and digests of documents."""
    assert len(derive_raw_tables(spark, contract.SMOKE_DIR).report_slices) == 1
    monkeypatch.setattr(testdata, "SLICE_BYTES", 1)
    monkeypatch.setattr(testdata, "MOST_SLICES", 3)
    derived = derive_raw_tables(spark, contract.SMOKE_DIR)
    assert len(derived.report_slices) == 3
    written = []

    class Slices(TableStore):
        def replace(self, name, df, *rest):
            written.append((name, df))
            return super().replace(name, df, *rest)

        def append(self, name, df, *rest):
            written.append((name, df))
            return super().append(name, df, *rest)

    feed = contract.Feeds(derived, Slices(spark))
    keyed = feed.report_keyed
    counts = [df.count() for name, df in written]
    assert [name for name, _ in written] == ["raw_report"] * 3 and min(counts) > 0
    assert sum(counts) == keyed.count() == spark.read.parquet(f"{contract.SMOKE_DIR}/orders.parquet").count()
    for _, df in written:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        dealt = plan[: plan.rindex("sha2(")]
        assert "text#" not in dealt and plan.count("pmod(xxhash64(") >= 3
        assert plan.rindex("High") > plan.index("Join")
    columns = derived.report.columns
    assert rows_of(feed.report, *columns) == rows_of(derived.report, *columns)
    key = derived.report.select("id", texts.text_key().alias("k"))
    assert rows_of(keyed, "id", texts.TEXT_KEY) == rows_of(key, "id", "k")
