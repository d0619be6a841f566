"""The plans are the ones that hold at scale."""

from __future__ import annotations

import re

import pytest
from conftest import AS_OF, feeds, rows_of
from pyspark.sql import functions as F

from reportstar.operators.bridging import resolve_members
from reportstar.plans import analytics, bridges, fact, staging, views
from reportstar.plans.keys import REPORT_LABELS
from reportstar.plans.pipeline import LABEL_DIM_TABLES, Star
from reportstar.sinks.store import TableStore, cut_lineage


def plan_of(df, executed: bool = False) -> str:
    if executed:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> int:
    return len(re.findall(r"\bExchange (?:hash|range|single|round)", plan, re.IGNORECASE))


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def skewed_star(spark):
    """20 000 reports, a third of them on one group key, with just the tables a country view
    and a country question read."""
    store = TableStore(spark)
    spread = F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(spread)
    reports = spark.range(0, 20000, 1, 8).select(
        F.col("id"),
        F.concat(F.lit("R"), F.col("id").cast("string")).alias("report_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("title"),
        *(F.lit(None).cast("string").alias(c) for c in ("description", "actions", "analysis")),
        *(F.lit("2024-01-01").cast("date").alias(c) for c in staging.REPORT_DATES),
        F.lit(AS_OF).alias("report_updated_at"),
        *(F.lit(-1).cast("long").alias(f"{d}_id") for d in REPORT_LABELS),
        *(hot.alias(c) for c in fact.GROUP_KEYS),
    )
    keys = reports.select("country_group_key").distinct()
    members = keys.select(
        "country_group_key",
        F.explode(F.expr("array(1L, 2L)")).alias("country_id"),
        F.lit(0.5).alias("weight_factor"),
        F.lit(False).alias("is_unknown_member"),
    )
    tables = {
        "fact_report": store.replace("fact_report", reports),
        "bridge_country": store.replace("bridge_country", members),
        "dim_country": store.replace(
            "dim_country",
            spark.createDataFrame([(-1, "Unknown"), (1, "A"), (2, "B")], "id long, country_name string"),
        ),
    }
    for d, table in LABEL_DIM_TABLES.items():
        if d != "country":
            label = views.LABEL_COLUMNS[d]
            dim = spark.createDataFrame([(-1, "Unknown")], f"id long, {label} string")
            tables[table] = store.replace(table, dim)
    return Star(tables, True, AS_OF)


def test_report_staging_has_no_nested_loop_and_pushes_the_type_filter(spark, no_broadcast):
    raw = feeds(spark, reports=[{"id": "1"}], adversaries=[{"adversary_id": "A", "report_ids": "1"}])
    report = TableStore(spark).replace("raw_report", raw.report)
    links = staging.link_adversaries(raw.adversary)
    plan = plan_of(staging.stage_reports(report, links))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "EqualTo(report_type,threat)" in plan


def test_narrow_consumers_do_not_read_texts(spark):
    report = TableStore(spark).replace("raw_report", feeds(spark, reports=[{"id": "1"}]).report)
    labels = staging.report_entity_labels(report)
    schema = re.search(r"ReadSchema: (\S+)", plan_of(labels)).group(1)
    assert schema == "struct<report_type:string,entity_ids:string,entity_names:string>"


def test_fact_sorts_in_ranges_and_shuffles_wide_rows_once(spark, no_broadcast):
    raw = feeds(spark, reports=[{"id": "1"}])
    links = staging.link_adversaries(raw.adversary)
    store = TableStore(spark)
    staged = fact.with_row_key(staging.stage_report_fields(raw.report))
    assert exchanges(plan_of(staged)) == 0
    stored = store.replace("stg_report", staged)
    claims = store.replace(
        "claims", staging.with_adversaries(stored.select("row_key", "report_id"), links)
    )
    dims = {
        d: spark.createDataFrame([(-1, "Unknown")], f"id long, {c} string")
        for d, c in REPORT_LABELS.items()
    }
    ranged = []

    def cut(df):
        ranged.append(plan_of(df))
        return cut_lineage(df)

    built = fact.report_fact(stored, claims, dims, AS_OF, cut)
    assert "rangepartitioning(report_id" in ranged[0]
    assert "SinglePartition" not in ranged[0] and "title" not in ranged[0]
    wide = [line for line in plan_of(built).splitlines() if "Exchange hashpartitioning(row_key" in line]
    assert len(wide) == 3  # the reports, their ids, and their adversaries
    # The only one-task exchange is over the row counts of the ranges.
    single = plan_of(built).split("SinglePartition")
    assert len(single) == 2 and "_rows" in single[1].splitlines()[1]


def test_bridge_exchanges_distinct_sets_only_and_hashes_them(spark):
    """One exchange that makes the sets distinct, one of these by key; reports are not sorted."""
    reports = spark.createDataFrame([("k", ["a", "b"])], "k string, m array<string>")
    lookup = spark.createDataFrame([("a", 1)], "member string, id long")
    plan = plan_of(resolve_members(reports, "k", "m", F.broadcast(lookup), "id"))
    assert exchanges(plan) == 2
    below = plan[plan.index("Generate explode") :]
    assert "SortAggregate" not in below and "Sort [" not in below and below.count("HashAggregate") == 2


def test_bridge_needs_one_more_on_each_side_if_not(spark, no_broadcast):
    reports = spark.createDataFrame([("k", ["a", "b"])], "k string, m array<string>")
    lookup = spark.createDataFrame([("a", 1)], "member string, id long")
    assert exchanges(plan_of(resolve_members(reports, "k", "m", lookup, "id"))) == 4


def test_distinct_counts_with_repeated_ids_split_the_hot_set(spark, small_partitions, skewed_star):
    """Every id on two reports with different sets, a third of all on one set."""
    repeated = skewed_star["fact_report"].withColumns(
        {
            "report_id": F.concat(F.lit("R"), (F.col("id") % 10000).cast("string")),
            "country_group_key": F.when(F.col("id") < 10000, F.col("country_group_key")).otherwise(
                F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))
            ),
        }
    )
    store = TableStore(spark)
    tables = {**skewed_star.tables, "fact_report": store.replace("fact_report", repeated)}
    question = analytics.weighted_country(Star(tables, False, AS_OF))
    assert "country_group_key" in split_joins(question)
    rows = tables["fact_report"].join(tables["bridge_country"], "country_group_key")
    want = rows.groupBy("country_id").agg(F.countDistinct("report_id")).collect()
    assert sorted(r["report_count"] for r in question.collect()) == sorted(r[1] for r in want)


@pytest.fixture
def small_partitions(spark, no_broadcast):
    """Thresholds of the adaptive skew join scaled down to the size of the test data."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def split_joins(df) -> list[str]:
    """The keys of the joins in the executed plan that had their hot partitions split."""
    return re.findall(r"SortMergeJoin\(skew=true\) \[(\w+)#", plan_of(df, executed=True))


def test_member_view_splits_the_hot_key(small_partitions, skewed_star):
    view = views.vw_report_country(skewed_star)
    assert view.count() == 40000
    assert "country_group_key" in split_joins(view)


def test_bridge_splits_a_hot_member(spark, small_partitions):
    """Every set holds the same member next to one of its own."""
    own = F.sha2(F.col("id").cast("string"), 256)
    sets = spark.range(0, 20000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("k"), F.array(F.lit("hot"), own).alias("m")
    )
    store = TableStore(spark)
    lookup = store.replace("lookup", spark.createDataFrame([("hot", 7)], "member string, id long"))
    bridge = resolve_members(store.replace("sets", sets), "k", "m", lookup, "id")
    assert "member" in split_joins(bridge)
    counts = {r["id"]: r["count"] for r in bridge.groupBy("id").count().collect()}
    assert counts == {7: 20000, -1: 20000}


def test_adversary_join_splits_a_hot_report_id(spark, small_partitions):
    rows = spark.range(0, 20000, 1, 8).select(
        F.col("id").alias("row_key"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
        .when(F.col("id") % 3 == 1, F.col("id").cast("string"))
        .alias("report_id"),
    )
    store = TableStore(spark)
    links = spark.createDataFrame([("HOT", ["A"])], "report_id string, adversary_ids array<string>")
    claims = staging.with_adversaries(store.replace("rows", rows), store.replace("links", links))
    assert "report_id" in split_joins(claims)
    assert claims.filter("adversary_members[0] = 'A'").count() == 6667


def test_counts_never_join_report_rows(spark, no_broadcast, skewed_star):
    """The reports are summed per set, map-side first, before they are exchanged."""
    plan = plan_of(analytics.weighted_country(skewed_star))
    lines = plan.splitlines()
    scan = next(i for i, text in enumerate(lines) if "struct<country_group_key:string>" in text)
    above = [text for text in reversed(lines[:scan]) if "Exchange" in text or "Aggregate" in text]
    assert "HashAggregate" in above[0] and "partial_count" in above[0]


def test_group_keys_travel_as_bytes(spark, no_broadcast):
    """Whatever is dealt by key or row on the way to bridges and fact carries 16 bytes of a key, and the key comes back."""
    raw = feeds(spark, reports=[{"id": "1", "country": "Oman"}, {"id": "2", "country": "Oman, Iran"}])
    store = TableStore(spark)
    stored = store.replace("stg_report", fact.with_row_key(staging.stage_report_fields(raw.report)))
    dim = spark.createDataFrame([(1, "Oman")], "id long, country_name string")
    bridge = bridges.country_bridge(stored, dim, AS_OF)
    claims = store.replace(
        "claims",
        staging.with_adversaries(stored.select("row_key", "report_id"), staging.link_adversaries(raw.adversary)),
    )
    dims = {d: spark.createDataFrame([(-1, "Unknown")], f"id long, {c} string") for d, c in REPORT_LABELS.items()}
    built = fact.report_fact(stored, claims, dims, AS_OF)
    for plan, keys in ((plan_of(bridge), 1), (plan_of(built), 4)):
        assert plan.count("unhex(") >= keys and plan.rindex("unhex(") > plan.index("Exchange")
    keys = {r[0] for r in stored.select("country_group_key").collect()}
    assert {r["country_group_key"] for r in bridge.collect()} == keys
    want = stored.join(claims.drop("report_id"), "row_key").select("report_id", *fact.GROUP_KEYS)
    assert rows_of(built, "report_id", *fact.GROUP_KEYS) == rows_of(want, "report_id", *fact.GROUP_KEYS)


def test_members_are_dealt_once_by_their_set(spark, no_broadcast, skewed_star):
    """Not by set and name first, to be summed, and by set again, to meet the reports."""
    question = analytics.weighted_country(skewed_star)
    dealt = re.findall(r"Exchange hashpartitioning\(country_group_key#\d+([^\n]*)", plan_of(question))
    assert len(dealt) == 2 and not any(", country_name" in keys for keys in dealt)
    rows = skewed_star["fact_report"].join(skewed_star["bridge_country"], "country_group_key")
    want = {r[0]: r[1] for r in rows.groupBy("country_id").count().collect()}
    names = {"A": 1, "B": 2}
    assert {names[r["country_name"]]: r["report_count"] for r in question.collect()} == want


def test_sets_of_a_bridge_travel_without_their_keys(spark):
    """The first exchange, which makes the sets distinct, carries a text per set and nothing else."""
    lists = ["Oman", "Oman, Iran", "A|B, C", "A, B|C", "", "Iran, Oman"]
    raw = feeds(spark, reports=[{"id": str(i), "country": c} for i, c in enumerate(lists)])
    stored = TableStore(spark).replace("stg_report", fact.with_row_key(staging.stage_report_fields(raw.report)))
    dim = spark.createDataFrame([(1, "Oman"), (2, "a|b")], "id long, country_name string")
    bridge = bridges.country_bridge(stored, dim, AS_OF)
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(bridge))
    of_sets = [keys for keys in dealt if "country_members" in keys]
    assert len(of_sets) == 1 and re.fullmatch(r"country_members#\d+, \d+", of_sets[0])
    want = resolve_members(
        stored, "country_group_key", "country_members", bridges._country_lookup(dim), "country_id"
    )
    assert rows_of(bridge, *want.columns) == rows_of(want, *want.columns)
