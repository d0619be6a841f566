"""The whole model on skewed hand-made feeds, against the SQL twins run on the same feeds."""

from __future__ import annotations

import random

import duckdb
import pytest
from conftest import AS_OF, feeds, rows_of, star_of

import oracle
from __spark_entry__ import BUILD_TIMES, comparable
from check import difference
from reportstar.plans import analytics, quality, views
from reportstar.plans.pipeline import STAR_TABLES, build_star, load_star
from reportstar.sinks.store import TableStore

BRIDGES = (*quality.REPORT_BRIDGES, "bridge_adversary_country")
TABLES = (*quality.DIMENSIONS, "entity_lookup", *BRIDGES)
QUESTIONS = {
    "bi_adversary_country": analytics.adversary_country,
    "bi_adversary_country_reports": analytics.adversary_country_reports,
    "bi_top_entities": analytics.top_entities,
    "bi_top_entities_severity": analytics.top_entities_severity,
    "bi_country_severity": analytics.country_severity,
    "bi_monthly_trend": analytics.monthly_trend,
    "bi_sector_breakdown": analytics.sector_breakdown,
    "bi_weighted_country": analytics.weighted_country,
    "dq_coverage_rates": quality.coverage_rates,
    "dq_unknown_rate": quality.unknown_rates,
    "dq_referential": quality.referential,
    "dq_weight_sum": quality.weight_sums,
    "dq_uniqueness": quality.uniqueness,
    "dq_member_coverage": quality.member_coverage,
    "bi_country_distribution": analytics.country_distribution,
    "bi_attribution_agreement": analytics.attribution_agreement,
    "bi_attribution_summary": analytics.attribution_summary,
}


def skewed(repeat_ids: bool) -> dict[str, list[dict]]:
    """A third of the reports share all their sets, a third have none, the rest vary."""
    rng = random.Random(11)
    reports = []
    for i in range(240):
        row = {
            "id": f"R{i}" if i % 9 else f"r{i}",
            "title": f"t{i}",
            "report_date": rng.choice(["01/02/2024", "2024-03-05", "12/31/2023", "?", None]),
            "classification": rng.choice([" Red", "red", "Amber ", "NUL"]),
            "importance": rng.choice(["High", "Low", "Medium", "odd", None]),
            "threat_type": rng.choice(["m", "n", " "]),
        }
        if i % 3 == 0:
            row |= {"country": "Oman, Qatar", "entity_ids": "E1|E2|Q9", "related_groups": "A1|Z"}
        elif i % 3 == 1:
            pick = lambda pool, k: rng.sample(pool, rng.randint(0, k))
            row |= {
                "country": ",".join(pick(["Oman", "oman ", "Qatar", "Yemen", "", " "], 4)),
                "entity_ids": rng.choice([None, "", "|".join(pick(["E1", "p2", "E7", "x"], 3))]),
                "entity_names": "|".join(pick(["name1", "label a", "Label b", "name 2"], 3)),
                "related_groups": "|".join(pick(["a1", "A2", "A3", "nobody", "noone"], 4)),
            }
        reports.append(row)
    if repeat_ids:
        for row in reports[:100]:
            row["id"] = "HOT"
    targets = [f"R{i}" for i in range(240) if i % 2] + ["HOT"]
    return {
        "reports": reports,
        "adversaries": [
            {"adversary_id": "A1", "adversary": "One", "report_ids": "|".join(targets)},
            {
                "adversary_id": "A2",
                "report_ids": "|".join(targets[::3]) + "|R1|R404",
                "targeted_country": "Oman|qatar|Oman",
            },
            {"adversary_id": "a3", "adversary": "Three", "report_ids": "R5|R7"},
            {"adversary_id": "A4", "adversary": "One", "targeted_country": "Iraq|Oman"},
            # Rows of an id that is there already: lists are put together.
            {"adversary_id": "A4", "adversary": "Four", "targeted_country": "oman|Yemen", "report_ids": "R3"},
            {"adversary_id": "A4", "targeted_country": "", "report_ids": "R3|R9|R10"},
            {"adversary_id": "A2", "report_ids": "R1"},
            {"adversary": "nobody", "report_ids": "R1"},
        ],
        "entities": [
            {"registry_id": "E1", "name_en": "n", "name_native": "name1", "sector": "s"},
            {"registry_id": "E2", "alt_id": "P2", "name_en": "n", "sector": "s", "category": "c"},
            {"registry_id": " E3", "alt_id": "e7", "name_native": "X"},
            {"registry_id": "E4", "alt_id": "NULL", "name_en": "E2"},
        ],
    }


@pytest.fixture(scope="module", params=[False, True], ids=["unique ids", "a hot report id"])
def both(request, spark):
    rows = skewed(request.param)
    raw = feeds(spark, **rows)
    star = build_star(raw, TableStore(spark), AS_OF)
    db = duckdb.connect()
    for name in ("report", "adversary", "entity"):
        frame = getattr(raw, name).toPandas()  # noqa: F841
        texts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in frame.columns)
        db.sql(f"CREATE TABLE raw_{name} AS SELECT {texts} FROM frame")
    return star, db, request.param


def differences(star, db, queries) -> dict[str, str]:
    found = {}
    for name, (query, dropped) in queries.items():
        sql = oracle.build(name, given=("raw_report", "raw_adversary", "raw_entity"))
        text = difference(comparable(query(star), dropped).toPandas(), db.sql(sql).df())
        if text:
            found[name] = text
    return found


def test_tables(both):
    star, db, _ = both
    tables = {n: (lambda s, n=n: s[n], BUILD_TIMES) for n in TABLES}
    assert differences(star, db, tables) == {}


def test_fact_ids_are_gap_free_in_report_order(both):
    star, db, _ = both
    ids = rows_of(star["fact_report"].sort("id"), "id", "report_id")
    assert sorted(i for i, _ in ids) == list(range(1, 241))
    in_order = [r for _, r in sorted(ids)]
    assert in_order == sorted(in_order)


def test_views(both):
    star, db, _ = both
    named = {n: (v, ()) for n, v in views.VIEWS.items()}
    if not star.unique_report_ids:
        # Which of two equal report ids gets the smaller id is open.
        del named["vw_report"]
    assert differences(star, db, named) == {}


def test_questions(both):
    star, db, repeated = both
    assert star.unique_report_ids is not repeated
    assert differences(star, db, {n: (q, ()) for n, q in QUESTIONS.items()}) == {}


def test_full_counts_equal_summed_counts_on_unique_ids(both):
    star, _, repeated = both
    if repeated:
        pytest.skip("only one of the two ways is right for repeated ids")
    full = star.__class__(star.tables, False, star.as_of)
    for question in (
        analytics.top_entities_severity, analytics.country_severity, analytics.weighted_country,
        views.vw_entity_coverage,
    ):
        ours = question(star)
        assert rows_of(ours, *ours.columns) == rows_of(question(full), *ours.columns)


def test_repeated_adversary_rows_are_one_adversary(spark):
    star = star_of(
        spark,
        reports=[{"id": "1", "related_groups": "A"}, {"id": "2"}],
        adversaries=[
            {"adversary_id": "A", "adversary": "b", "report_ids": "1", "targeted_country": "Oman"},
            {"adversary_id": "A", "adversary": "a", "report_ids": "2", "targeted_country": "Qatar|oman"},
        ],
    )
    assert rows_of(star["dim_adversary"].filter("id > 0"), "id", "adversary_name") == [(1, "a")]
    assert rows_of(star["adversary_links"], "report_id", "adversary_ids") == [("1", ["A"]), ("2", ["A"])]
    assert rows_of(star["bridge_adversary_country"], "member_value", "weight_factor") == [("OMAN", 0.5), ("QATAR", 0.5)]
    weights = views.vw_report_adversary(star).groupBy("report_id").sum("weight_factor")
    assert rows_of(weights, *weights.columns) == [("1", 1.0), ("2", 1.0)]
    assert {r[0] for r in quality.uniqueness(star).select("repeated_keys").collect()} == {0}


def test_weight_sum_sees_a_repeated_dimension_row(spark):
    star = star_of(spark, reports=[{"id": "1", "country": "Oman"}])
    twice = star["dim_country"].unionByName(star["dim_country"].filter("id = 1"))
    broken = star.__class__({**star.tables, "dim_country": twice}, True, star.as_of)
    off = dict(rows_of(quality.weight_sums(broken), "bridge", "reports_off"))
    assert off["bridge_country"] == 1 and off["bridge_entity"] == 0


@pytest.mark.parametrize("stop", [*STAR_TABLES, "scratch_fact_positions"])
def test_a_build_that_stops_is_not_read_as_a_good_one(spark, tmp_path_factory, stop):
    """A second build on repeated ids breaks at each table in turn."""

    class Breaking(TableStore):
        def replace(self, name, df, *rest):
            if name == stop:
                raise OSError(name)
            return super().replace(name, df, *rest)

        def append(self, name, df, *rest, **named):
            if name == stop:
                raise OSError(name)
            return super().append(name, df, *rest, **named)

    root = str(tmp_path_factory.mktemp("broken"))
    store = Breaking(spark, root)
    with pytest.raises(OSError):
        star_of(spark, store, reports=[{"id": "1", "country": "Oman"}] * 3)
    with pytest.raises(RuntimeError, match="not ended"):
        load_star(TableStore(spark, root))


def test_create_views_for_sql(both, spark):
    star, _, _ = both
    views.create_views(star)
    count = spark.sql("SELECT count(DISTINCT report_id) FROM vw_report_country").first()[0]
    assert count == star["fact_report"].select("report_id").distinct().count()


def test_unresolved_members_collapse(spark):
    """Three unresolved members and one known: two rows of one half each (Q12)."""
    star = star_of(
        spark,
        reports=[{"id": "1", "related_groups": "z|y|x|A1"}],
        adversaries=[{"adversary_id": "A1"}],
    )
    assert rows_of(
        star["bridge_group_adversary"],
        "adversary_dim_id", "member_value", "member_count", "weight_factor",
    ) == [(-1, "X", 2, 0.5), (1, "A1", 2, 0.5)]


def test_priority_of_entity_matches(spark):
    """Registry id, alternative id, native name, English name; then the smallest id."""
    star = star_of(
        spark,
        reports=[{"id": "1", "entity_ids": "K1|K2|K3|K4|Unknown"}],
        entities=[
            {"registry_id": "A", "alt_id": "K1", "name_native": "K2", "name_en": "K3"},
            {"registry_id": "K1", "name_en": "K4"},
            {"registry_id": "B", "alt_id": "K2", "name_native": "K3", "name_en": "K4"},
        ],
    )
    keys = dict(rows_of(star["dim_entity"], "registry_id", "id"))
    found = dict(rows_of(star["entity_lookup"], "member", "entity_id"))
    assert [found[k] for k in ("K1", "K2", "K3", "K4", "UNKNOWN")] == [
        keys["K1"], keys["B"], keys["B"], keys["B"], -1,
    ]


def test_unknown_as_a_real_value_does_not_fan_out(spark):
    star = star_of(
        spark,
        reports=[{"id": "1", "classification": "Unknown", "country": "unknown,Oman"}],
    )
    assert star["fact_report"].count() == 1
    assert rows_of(star["bridge_country"], "country_id", "member_value") == [
        (-1, "UNKNOWN"), (1, "OMAN"),
    ]


def test_empty_feeds(spark):
    star = star_of(spark)
    assert star["fact_report"].count() == 0
    assert star["dim_country"].count() == 1
    assert rows_of(views.vw_entity_coverage(star), "value") == [(0,)] * 5
    assert analytics.weighted_country(star).count() == 0
    assert {r[0] for r in quality.referential(star).select("orphan_rows").collect()} == {0}


def test_freshness(spark):
    from datetime import timedelta

    star = star_of(spark, reports=[{"id": "1", "updated_at": "2025-12-31 00:00:00"}])
    got = quality.freshness(star, AS_OF + timedelta(hours=1))
    rows = {r["table"]: (r["refresh_age_seconds"], r["newest_age_seconds"]) for r in got.collect()}
    assert rows["dim_country"] == (3600, 3600)
    assert rows["fact_report"] == (3600, 90000)
