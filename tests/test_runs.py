"""Runs published at once, taken up again after a failure, and two at a time."""

from __future__ import annotations

from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime, timedelta

import pytest
from conftest import AS_OF, feeds, rows_of
from pyspark.sql import functions as F

from reportstar.plans import measures, quality
from reportstar.plans.pipeline import LAYERS, STAGING, STAR_TABLES, build_star, load_star
from reportstar.sinks.files import SmallFiles
from reportstar.sinks.runs import RunStore
from reportstar.sources import RawTables
from reportstar.sources.raw import feed_fingerprint

LATER = AS_OF + timedelta(days=1)


def first_feeds(spark):
    return feeds(
        spark,
        reports=[{"id": "1", "country": "Oman", "entity_ids": "E1"}, {"id": "2", "country": "Qatar"}],
        adversaries=[{"adversary_id": "A", "report_ids": "1", "targeted_country": "Oman"}],
        entities=[{"registry_id": "E1"}],
    )


def second_feeds(spark):
    return feeds(
        spark,
        reports=[{"id": "3", "country": "Aden", "entity_ids": "E2"}] * 2,
        adversaries=[{"adversary_id": "B", "report_ids": "3", "targeted_country": "Oman"}],
        entities=[{"registry_id": "E2"}],
    )


def stored(raw, spark, folder):
    """The feeds as files."""
    for name in ("report", "adversary", "entity"):
        getattr(raw, name).write.parquet(f"{folder}/{name}")
    return RawTables.from_parquet(spark, *(f"{folder}/{n}" for n in ("report", "adversary", "entity")))


def contents(star):
    """All rows but for the row keys, which number rows as they were written."""
    return {
        name: Counter(map(repr, star[name].drop("row_key").select(sorted(set(star[name].columns) - {"row_key"})).collect()))
        for name in STAR_TABLES
    }


class Breaking(RunStore):
    """Fails at some tables; counts what it writes."""

    def __init__(self, *args, stop=()):
        super().__init__(*args)
        self.stop, self.written = {*stop}, []

    def replace(self, name, df, *rest):
        if name in self.stop:
            raise OSError(name)
        self.written.append(name)
        return super().replace(name, df, *rest)

    def extend(self, name, *rest, **named):
        if name in self.stop:
            raise OSError(name)
        return super().extend(name, *rest, **named)

    def publish(self):
        if "publish" in self.stop:
            raise OSError("publish")
        super().publish()


def test_readers_keep_the_run_before_whole_while_builds_break(spark, tmp_path):
    """A build on other feeds breaks at each table in turn, and is taken up again at each."""
    root = str(tmp_path / "star")
    build_star(first_feeds(spark), RunStore(spark, root), AS_OF)
    before = contents(load_star(RunStore.published(spark, root)))
    raw = stored(second_feeds(spark), spark, tmp_path / "raw")
    order = [*STAGING, "dim_key", *(name for layer in LAYERS for name in layer), "publish"]
    assert {*order} == {*STAR_TABLES, "publish"}
    for k in range(len(order)):
        broken = Breaking(spark, root, stop=order[k:])
        with pytest.raises(OSError):
            build_star(raw, broken, LATER)
        assert len({*broken.written} & {*STAR_TABLES}) <= 1
        assert load_star(RunStore.published(spark, root)).as_of == AS_OF
    assert contents(load_star(RunStore.published(spark, root))) == before
    star = build_star(raw, RunStore(spark, root), LATER)
    assert contents(load_star(RunStore.published(spark, root))) == contents(star) != before


def test_nothing_published_yet(spark, tmp_path):
    with pytest.raises(LookupError):
        RunStore.published(spark, str(tmp_path))


def test_a_retry_goes_on_where_the_run_broke(spark, tmp_path):
    raw = stored(first_feeds(spark), spark, tmp_path / "raw")
    root = str(tmp_path / "star")
    with pytest.raises(OSError):
        build_star(raw, Breaking(spark, root, stop=["fact_report"]), AS_OF)
    again = Breaking(spark, root)
    star = build_star(raw, again, AS_OF)
    assert not {"stg_report", "stg_adversary", "stg_entity", "adversary_links", "dim_country"} & {*again.written}
    assert "fact_report" in again.written
    clean = build_star(raw, RunStore(spark, str(tmp_path / "clean")), AS_OF)
    assert contents(star) == contents(clean) == contents(load_star(RunStore.published(spark, root)))


def test_only_what_a_changed_feed_touches_is_made_again(spark, tmp_path):
    raw = stored(first_feeds(spark), spark, tmp_path / "raw")
    root = str(tmp_path / "star")
    build_star(raw, RunStore(spark, root), AS_OF)
    same = Breaking(spark, root)
    build_star(raw, same, AS_OF)
    assert {*same.written} == {"star_info"}
    second_feeds(spark).adversary.write.mode("append").parquet(str(tmp_path / "raw/adversary"))
    more = RawTables.from_parquet(spark, *(str(tmp_path / "raw" / n) for n in ("report", "adversary", "entity")))
    changed = Breaking(spark, root)
    star = build_star(more, changed, AS_OF)
    assert {"stg_adversary", "adversary_links", "dim_adversary", "fact_report"} <= {*changed.written}
    assert not {"stg_report", "stg_entity"} & {*changed.written}
    assert rows_of(star["dim_adversary"].filter("id > 0"), "id", "adversary_id") == [(1, "A"), (2, "B")]
    # Another report type, another build time: other rows.
    other = Breaking(spark, root)
    build_star(more, other, AS_OF, report_type="other")
    assert "stg_report" in other.written
    dated = Breaking(spark, root)
    build_star(more, dated, LATER)
    assert "dim_country" in dated.written and "stg_report" not in dated.written


def test_one_model_alone(spark, tmp_path):
    root = str(tmp_path)
    raw = first_feeds(spark)
    build_star(raw, RunStore(spark, root), AS_OF)
    store = Breaking(spark, root)
    star = build_star(raw, store, LATER, only=["bridge_country"])
    assert {*store.written} == {"star_info", "bridge_country"}
    assert {r[0] for r in star["bridge_country"].select("updated_at").collect()} == {LATER}
    assert {r[0] for r in star["bridge_entity"].select("updated_at").collect()} == {AS_OF}
    assert contents(load_star(RunStore.published(spark, root))) == contents(star)
    with pytest.raises(ValueError, match="bridge_nothing"):
        build_star(raw, RunStore(spark, root), LATER, only=["bridge_nothing"])


def test_old_runs_go_after_a_grace_period(spark, tmp_path):
    root = str(tmp_path)
    raw = first_feeds(spark)
    old, kept = RunStore(spark, root), RunStore(spark, root)
    build_star(raw, old, AS_OF)
    reader = load_star(RunStore.published(spark, root))
    build_star(raw, kept, LATER)
    assert reader["fact_report"].count() == 2
    day = timedelta(days=1)
    assert kept.remove_old_runs(day) == []
    assert kept.remove_old_runs(day, datetime.now(UTC) + 2 * day) == [old.run]
    assert kept.files.names("runs") == sorted([kept.run, f"{kept.run}.json"])
    assert load_star(RunStore.published(spark, root))["fact_report"].count() == 2


def test_two_runs_hand_out_no_id_twice(spark, tmp_path):
    """Both begin from the same registry; the second to be ready numbers its keys anew."""
    root = str(tmp_path)
    build_star(first_feeds(spark), RunStore(spark, root), AS_OF)
    reports = [[{"id": f"{k}{i}", "country": f"{k} {i}"} for i in range(5)] for k in "xyz"]
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(build_star, feeds(spark, reports=r), RunStore(spark, root), LATER) for r in reports]
        stars = [j.result() for j in jobs]
    whole = RunStore(spark, root).extend("dim_key", lambda existing: existing.filter("false"), ["dimension"])
    ids = [(r["dimension"], r["id"]) for r in whole.collect()]
    assert len(ids) == len(set(ids)) and len({r["natural_key"] for r in whole.filter("dimension = 'country'").collect()}) == 17
    for star in stars:
        known = {(r["natural_key"], r["id"]) for r in star["dim_key"].filter("dimension = 'country'").collect()}
        assert known <= {(r["natural_key"], r["id"]) for r in whole.collect()}
        assert star["dim_country"].filter("id > 0").count() == len(known)


def test_small_files_are_created_once(spark, tmp_path):
    files = SmallFiles(spark, str(tmp_path))
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: files.create("versions/1", str(i)), range(16)))
    assert sum(won) == 1 and files.read("versions/1") == str(won.index(True))
    assert files.names("versions") == ["1"] and files.names("nothing") == [] and files.read("none") is None


def test_small_files_through_another_file_system(spark, tmp_path):
    """By a path that only Spark's file systems can open."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.small.link./in", f"file://{tmp_path}")
    files = SmallFiles(spark, "viewfs://small/in")
    assert not files.local
    assert files.create("a/1", "one é") and not files.create("a/1", "two") and files.read("a/1") == "one é"
    files.replace("a/1", "three")
    assert files.read("a/1") == "three" and files.names("a") == ["1"]
    files.delete("a/1")
    assert files.read("a/1") is None


def test_fingerprint_of_a_feed(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    first = feed_fingerprint(spark.read.parquet(path))
    assert first and feed_fingerprint(spark.read.parquet(path)) == first
    assert feed_fingerprint(spark.read.parquet(path).filter(F.col("id") > 1)) != first
    spark.range(1).write.mode("append").parquet(path)
    assert feed_fingerprint(spark.read.parquet(path)) != first
    assert feed_fingerprint(spark.range(5)) is None


def measures_of(frame):
    return sorted(map(tuple, frame.select("relation", "measure", "value").collect()))


def test_what_a_build_observes_is_what_a_scan_finds(spark, tmp_path):
    """In a new run, in one that takes tables over, in one of a single model, and on no rows; rates read no table."""
    raw, root = stored(first_feeds(spark), spark, tmp_path / "raw"), str(tmp_path / "star")
    build_star(raw, RunStore(spark, root), AS_OF)
    runs = [load_star(RunStore.published(spark, root))]
    again = Breaking(spark, root)
    build_star(raw, again, AS_OF)
    assert "bridge_country" not in again.written
    runs.append(load_star(RunStore.published(spark, root)))
    runs.append(build_star(raw, RunStore(spark, root), LATER, only=["bridge_entity", "dim_entity"]))
    runs.append(build_star(feeds(spark), RunStore(spark, str(tmp_path / "empty")), AS_OF))
    for star in runs:
        assert measures_of(star.measures) == measures_of(measures.scanned(star.tables))
        files = [f for check in (quality.unknown_rates, quality.coverage_rates) for f in check(star).inputFiles()]
        assert files and all("star_measures" in f for f in files)
