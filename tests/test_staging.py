from __future__ import annotations

from conftest import feeds, rows_of
from pyspark.sql import functions as F

from reportstar.plans import staging
from reportstar.sources import RawTables


def staged(spark, **rows):
    raw = feeds(spark, **rows)
    return staging.stage_reports(raw.report, staging.link_adversaries(raw.adversary))


def entities(spark, **rows):
    raw = feeds(spark, **rows)
    return staging.stage_entities(raw.entity, raw.report)


def test_only_the_report_type_is_staged(spark):
    got = staged(spark, reports=[{"id": "R1"}, {"id": "R2", "report_type": "other"}])
    assert rows_of(got, "report_id") == [("R1",)]


def test_lower_case_report_ids_are_never_linked(spark):
    got = staged(
        spark,
        reports=[{"id": "R1"}, {"id": "r2"}, {"id": None}, {"id": "R3"}],
        adversaries=[
            {"adversary_id": "A2", "report_ids": "r1|r2"},
            {"adversary_id": "A1", "report_ids": "R1 | R9"},
            {"adversary_id": None, "report_ids": "R3"},
        ],
    )
    assert rows_of(got, "report_id", "adversary_members") == [
        ("R1", ["A1", "A2"]),
        ("R3", ["UNKNOWN"]),
        ("r2", ["UNKNOWN"]),
        (None, ["UNKNOWN"]),
    ]


def test_repeated_report_ids_stay_apart_and_get_the_same_adversaries(spark):
    got = staged(
        spark,
        reports=[{"id": "R1", "title": "a"}, {"id": "R1", "title": "b"}],
        adversaries=[{"adversary_id": "A", "report_ids": "R1|R1"}],
    )
    assert rows_of(got, "title", "adversary_members") == [("a", ["A"]), ("b", ["A"])]


def test_ids_win_over_names_as_a_whole(spark):
    got = staged(
        spark,
        reports=[
            {"id": "1", "entity_ids": "x", "entity_names": "n|m"},
            {"id": "2", "entity_ids": " ", "entity_names": "n|m"},
            {"id": "3"},
        ],
    )
    assert rows_of(got, "report_id", "entity_members") == [
        ("1", ["X"]), ("2", ["M", "N"]), ("3", ["UNKNOWN"]),
    ]


def test_first_entity_row_by_name_null_first_then_all_columns(spark):
    got = entities(
        spark,
        entities=[
            {"registry_id": " E1", "name_en": "B", "alt_id": "p"},
            {"registry_id": "E1 ", "name_en": "A", "alt_id": "z"},
            {"registry_id": "E1", "name_en": "A", "alt_id": "q"},
            {"registry_id": "E2", "name_en": "A"},
            {"registry_id": "E2", "name_en": "nul"},
            {"registry_id": None, "name_en": "no id"},
        ],
    )
    assert rows_of(got, "registry_id", "name_en", "alt_id") == [
        ("E1", "A", "q"), ("E2", None, None),
    ]


def test_blank_registry_id_is_a_key(spark):
    got = entities(spark, entities=[{"registry_id": "  ", "name_native": "x"}])
    assert rows_of(got, "entity_natural_key", "registry_id") == [("", "")]


def test_names_register_only_where_ids_are_null(spark):
    got = entities(
        spark,
        reports=[
            {"id": "1", "entity_names": "seen| also "},
            {"id": "2", "entity_ids": "", "entity_names": "blank ids"},
            {"id": "3", "entity_names": "other", "report_type": "other"},
        ],
        entities=[{"registry_id": "E1", "name_native": "SEEN"}],
    )
    assert rows_of(got, "entity_natural_key", "name_en", "is_registered") == [
        ("ALSO", "also", False), ("E1", None, True),
    ]


def test_one_row_per_natural_key(spark):
    got = entities(
        spark,
        reports=[{"id": "1", "entity_names": "abc|Abc|E1"}],
        entities=[{"registry_id": "e1", "name_native": "n"}],
    )
    assert rows_of(got, "entity_natural_key", "name_native", "is_registered") == [
        ("ABC", "Abc", False), ("E1", "n", True),
    ]


def test_feeds_with_other_column_names(spark):
    raw = feeds(spark, reports=[{"id": "1"}], adversaries=[{"adversary_id": "A"}])
    theirs = raw.adversary.withColumnRenamed("report_ids", "their_ids")
    same = RawTables.from_frames(
        raw.report, theirs, raw.entity, {"adversary": {"their_ids": "report_ids"}}
    )
    assert same.adversary.columns == raw.adversary.columns


def test_rows_of_a_hot_adversary_meet_in_no_task(spark):
    """One id on a third of the feed, each row with lists of its own; the others have a row each."""
    rows = [
        {"adversary_id": "HOT" if i % 3 == 0 else f"A{i}", "report_ids": f"r{i}|R{i + 1}", "targeted_country": f"c{i % 7}"}
        for i in range(3000)
    ]
    raw = feeds(spark, adversaries=rows)
    links = staging.link_adversaries(raw.adversary.repartition(8))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tasks = links.groupBy(F.spark_partition_id().alias("task")).count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) > 1 and max(t["count"] for t in tasks) < 2 * 3001 / len(tasks)
    assert dict(rows_of(links.filter("report_id < 'R103'"), "report_id", "adversary_ids"))["R10"] in (
        ["A10", "HOT"], ["HOT", "A10"]
    )
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(report_id" in plan
    hot = staging.stage_adversaries(raw.adversary).filter("adversary_id = 'HOT'").first()
    assert hot["country_members"] == [f"C{k}" for k in range(7)]
    assert hot["member_reports"] == sorted({f"R{i + k}" for i in range(0, 3000, 3) for k in (0, 1)})
    targets = staging.adversary_targets(raw.adversary)
    assert "report_ids" not in targets._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]
    assert rows_of(targets, "adversary_id", "country_group_key") == rows_of(
        staging.stage_adversaries(raw.adversary), "adversary_id", "country_group_key"
    )
