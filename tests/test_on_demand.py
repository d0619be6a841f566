"""A query writes the tables below it, and the whole star is the same in whatever order its tables are first read."""

from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import AS_OF, feeds, rows_of

import __spark_entry__ as contract
from reportstar.plans import measures, quality
from reportstar.plans.pipeline import STAR_TABLES, build_star, load_star
from reportstar.sinks.store import TableStore

STAGED = {"raw_report", "raw_adversary", "raw_entity", "stg_report", "stg_adversary", "stg_entity"}
KEYED = {*STAGED, "dim_key", "scratch_key_positions"}
LINKED = {"adversary_links", "stg_report_adversary"}
LABELS = {*contract.LABEL_DIM_TABLES.values()}
FACT = {*KEYED, *LINKED, *LABELS, "fact_report", "scratch_fact_positions"}
TWO_RUNS = {"query_two_runs", "scratch_query_earlier", "scratch_query_later"}
TEXTS = {"raw_report_text", "report_text"}
TARGETS = {"dim_adversary", "bridge_adversary", "bridge_adversary_country"}
BELOW = {
    "dim_key_first_run": {*STAGED, "scratch_query_first_run"},
    "dim_key_second_run": {*STAGED, *TWO_RUNS},
    "dim_source": KEYED,
    "dq_freshness": {*FACT, *TWO_RUNS},
    "bi_adversary_country_reports": {*FACT, *TARGETS},
    "vw_report": {*FACT, *TEXTS},
    "vw_report_adversary": {*FACT, "dim_adversary", "bridge_adversary"},
    "vw_report_country": {*FACT, "bridge_country"},
}


class Counting(TableStore):
    def __init__(self, spark):
        super().__init__(spark)
        self.written: list[str] = []

    def replace(self, name, df, *rest):
        self.written.append(name)
        return super().replace(name, df, *rest)

    def append(self, name, df, *rest):
        if name not in self.written:
            self.written.append(name)
        return super().append(name, df, *rest)


@pytest.fixture
def build(spark, monkeypatch):
    monkeypatch.setattr(contract, "_builds", {})
    made = contract.build(spark, contract.SMOKE_DIR)
    made.store = Counting(spark)
    return made


@pytest.mark.parametrize("name", BELOW)
def test_a_query_writes_the_tables_below_it(spark, build, name):
    assert contract.queries()[name](spark, contract.SMOKE_DIR).count() > 0
    assert sorted(build.store.written) == sorted(BELOW[name])


REPORTS = [
    {"id": "1", "country": "Oman", "entity_ids": "E1|X", "related_groups": "A", "description": "d"},
    {"id": "2", "country": "Iran, oman", "entity_names": "Y", "observation_source": "web", "actions": "d"},
    {"id": "2", "updated_at": "01/02/2020 06:30:00"},
]
ADVERSARIES = [{"adversary_id": "A", "adversary": "a", "report_ids": "1|2", "targeted_country": "Oman"}]
ENTITIES = [{"registry_id": "E1", "name_en": "one", "name_native": "eins"}]


def test_tables_read_one_by_one_are_those_of_the_build(spark, build):
    raw = feeds(spark, reports=REPORTS, adversaries=ADVERSARIES, entities=ENTITIES)
    build._raw = contract.Feeds(raw, build.store)
    star = build.tables
    for name in reversed(STAR_TABLES):
        star[name].count()
    whole = build_star(raw, TableStore(spark), AS_OF)
    shown = load_star(TableStore(spark, build.store.root)) if build.star else None
    for name in STAR_TABLES:
        columns = [c for c in whole[name].columns if c != "row_key"]
        assert rows_of(shown[name], *columns) == rows_of(star[name], *columns) == rows_of(whole[name], *columns)
    columns = measures.SCHEMA.replace(" string", "").replace(" long", "").split(", ")
    assert rows_of(star.measures, *columns) == rows_of(whole.measures, *columns)
    assert star.unique_report_ids is shown.unique_report_ids is whole.unique_report_ids is False
    made = [name for name in build.store.written if name != "star_info"]
    assert len(made) == len({*made})


def test_ages_need_only_the_relations_that_have_one(spark, build):
    star = build.star
    some = measures.relations_with("refreshed")
    assert {*some} == {*quality.DIMENSIONS, "fact_report"}
    now = AS_OF + timedelta(days=1)
    columns = ["table", "refresh_age_seconds", "newest_age_seconds"]
    assert rows_of(quality.ages(measures.scanned(star.tables, some), now), *columns) == rows_of(
        quality.freshness(star, now), *columns
    )
