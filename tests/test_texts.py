"""Texts are stored once and meet the reports where they are read."""

from __future__ import annotations

import re

import pytest
from conftest import AS_OF, feeds, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as contract
from reportstar.functions import group_key
from reportstar.plans import analytics, fact, quality, staging, texts, views
from reportstar.plans.pipeline import build_star, load_star
from reportstar.plans.views import vw_report
from reportstar.sinks.store import TableStore
from reportstar.sources import derive_raw_tables, testdata

LONG = "".join(f"word{i} " for i in range(2000))
REPORTS = [
    *({"id": str(i), "description": LONG, "actions": LONG if i % 2 else None} for i in range(200)),
    {"id": "200", "country": "Oman"},
    {"id": "201", "description": "", "analysis": "-"},
    {"id": "202", "actions": "a"},
    {"id": "203", "analysis": "a"},
    {"id": "204", "report_type": "other", "analysis": "not staged"},
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def built(spark):
    store = TableStore(spark)
    build_star(feeds(spark, reports=REPORTS), store, AS_OF)
    return store


def test_no_layer_holds_the_texts_of_every_report(spark, built):
    for name in ("stg_report", "fact_report"):
        assert not set(texts.TEXTS) & set(built.read(name).columns)
    stored = built.read("report_text")
    assert stored.count() == stored.select(texts.TEXT_KEY).distinct().count() == 5


def test_the_star_shows_every_report_with_its_texts(spark, built):
    got = rows_of(load_star(built)["fact_report"], "report_id", *texts.TEXTS)
    fed = [r for r in REPORTS if "report_type" not in r]
    assert got == sorted(((r["id"], *map(r.get, texts.TEXTS)) for r in fed), key=repr)


def test_texts_are_read_only_where_they_are_shown(spark, built):
    star = load_star(built)
    for narrow in (star["fact_report"].groupBy("country_group_key").count(), vw_report(star).select("id", "title")):
        assert not re.search("description", plan_of(narrow))
    assert "description" in plan_of(vw_report(star))


def test_a_feed_is_written_when_it_is_read(spark):
    class Counting(TableStore):
        written: list[str] = []

        def replace(self, name, df, *rest):
            self.written.append(name)
            assert name == "raw_report_text" or "description" not in df.columns
            return super().replace(name, df, *rest)

    raw = feeds(spark, reports=REPORTS, adversaries=[{"adversary_id": "A", "report_ids": "1"}])
    store = Counting(spark)
    feed = contract.Feeds(raw, store)
    assert feed.adversary.count() == 1 and store.written == ["raw_adversary"]
    columns = raw.report.columns
    assert rows_of(feed.report, *columns) == rows_of(raw.report, *columns)
    narrow = feed.report.filter(F.col("report_type") == "threat").select("id", "country")
    assert "Join" not in plan_of(narrow) and "description" not in plan_of(narrow)


def test_only_keys_of_texts_travel_to_their_reports(spark):
    """A feed in two parts: digests are taken where the texts are, and no wide row is dealt by text."""
    plans = {}

    class Planning(TableStore):
        def replace(self, name, df, *rest):
            plans[name] = plan_of(df)
            return super().replace(name, df, *rest)

    derived = derive_raw_tables(spark, contract.SMOKE_DIR)
    feed = contract.Feeds(derived, Planning(spark)).report
    assert plans["raw_report"].index("LeftOuter") < plans["raw_report"].index("sha2(")
    assert "c_mktsegment" not in plans["raw_report_text"]
    columns = derived.report.columns
    assert rows_of(feed, *columns) == rows_of(derived.report, *columns)
    documents = spark.read.parquet(f"{contract.SMOKE_DIR}/documents.parquet").select("text")
    assert feed.select(F.col("description").alias("text")).dropna().subtract(documents).isEmpty()
    assert feed.filter("description IS NOT NULL").count() > 0


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_group_keys_meet_texts_as_bytes(spark, built, no_broadcast):
    """Whatever is dealt by the key of its texts carries 16 bytes of a group key."""
    star = load_star(built)
    for shown in (vw_report(star), fact.beside_texts(built.read("fact_report"), built.read("report_text"))):
        plan = shown._jdf.queryExecution().executedPlan().toString()
        assert plan.count("unhex(") >= 4 and plan.rindex("unhex(") > plan.index("Exchange hashpartitioning(text_key")
        assert rows_of(shown, "report_id", *fact.GROUP_KEYS, *texts.TEXTS) == rows_of(
            star["fact_report"], "report_id", *fact.GROUP_KEYS, *texts.TEXTS
        )


def test_sets_travel_as_text_without_their_keys(spark):
    lists = [None, "", " , ", "Oman", "oman, Iran,Oman", "A|B, C", "A, B|C", "ß, ǆ"]
    rows = [
        {"id": str(i), "country": c, "entity_ids": e, "related_groups": g}
        for i, (c, e, g) in enumerate(zip(lists, [*lists[1:], "x|y"], [*lists[2:], "p,q|r", " | "]))
    ]
    staged = staging.stage_report_keys(feeds(spark, reports=rows).report).withColumn(
        "adversary_members", F.array(F.lit("A|B"), F.lit("C,D"))
    )
    whole = staged.withColumn("adversary_group_key", group_key(F.col("adversary_members")))
    packed = staging.packed_sets(whole)
    assert not {c for c in packed.columns if c.endswith("_group_key")}
    assert {packed.schema[c].dataType.simpleString() for c in staging.DELIMITED} == {"string"}
    assert rows_of(staging.unpacked_sets(packed), *whole.columns) == rows_of(whole, *whole.columns)


@pytest.mark.parametrize(
    "ask", [quality.uniqueness, quality.weight_sums, views.vw_report_entity, views.vw_report_adversary]
)
def test_sets_are_dealt_by_the_bytes_of_their_keys(spark, built, no_broadcast, ask):
    assert "unhex(" in ask(load_star(built))._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_sets_meet_their_adversaries_in_their_row(spark, built, no_broadcast):
    """The fan-out of pairs x adversaries is summed per adversary, and not dealt by pair."""
    plan = analytics.attribution_summary(load_star(built))._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(([^\n]*), ENSURE", plan)
    assert not [keys for keys in dealt if "adversary_id" in keys and "group_key" in keys]


def test_keys_of_texts_are_16_bytes(spark, built):
    keys = built.read("report_text").select(F.length(texts.TEXT_KEY).alias("n"))
    assert {row["n"] for row in keys.collect()} == {16}


def test_lists_of_adversaries_are_gathered_as_numbers(spark):
    """Names that follow from keys do not travel; lines without a brand stay one campaign without a name."""
    lines = spark.createDataFrame(
        [(1, 50, "A", "R", "X"), (999, 1, "B", "R", "X"), (1000, 50, "B", "R", "X"), (2, 1, "A", "N", "X")]
        + [(5, 50, "A", "R", None), (5000, 50, "B", "R", None)],
        "l_orderkey long, l_quantity int, n_name string, l_returnflag string, p_brand string",
    )
    found = testdata._adversaries(lines)
    assert rows_of(found, "adversary_id", "adversary", "report_ids", "targeted_country") == sorted(
        [
            ("X-0", "Actor X-0", "RPT-1|RPT-999", "A"),
            ("X-1", "Actor X-1", "RPT-1000", "B"),
            (None, None, "RPT-5|RPT-5000", "A|B"),
        ],
        key=repr,
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "RPT-" not in plan[plan.index("Exchange hashpartitioning") :]
