from __future__ import annotations

import pytest
from conftest import AS_OF, rows_of, star_of
from pyspark.errors import AnalysisException, ArithmeticException
from pyspark.sql.types import StructType

from reportstar.plans import views
from reportstar.plans.analytics import weighted_country
from reportstar.plans.pipeline import STAR_TABLES, load_star
from reportstar.sinks import jdbc
from reportstar.sinks.contracts import CONTRACTS, GENERATED, conform, overlong_keys
from reportstar.sinks.export import export_star
from reportstar.sinks.store import CatalogStore, TableStore, cut_lineage, scratch_table, shared_folder


def test_page_count():
    assert [jdbc.page_count(n) for n in (0, 1, 100_000, 100_001, 10**9)] == [1, 1, 1, 2, 8]
    assert jdbc.page_count(10**9, paged=False) == 1


def test_page_plan_follows_the_same_rule(spark):
    counts = [0, 1, 100_000, 100_001, 10**9]
    df = spark.createDataFrame([(n,) for n in counts], "rows long")
    got = {r["rows"]: r["pages"] for r in jdbc.page_plan(df).collect()}
    assert got == {n: jdbc.page_count(n) for n in counts}


def test_schemas_must_agree_in_name_type_and_order():
    schema = lambda ddl: StructType.fromDDL(ddl)
    jdbc.verify_schema(schema("a bigint, b string"), schema("a bigint, b string"))
    for other in ("a int, b string", "b string, a bigint", "a bigint", "a bigint, c string"):
        with pytest.raises(ValueError, match="do not match"):
            jdbc.verify_schema(schema("a bigint, b string"), schema(other))


def test_what_differs_is_told_by_column():
    schema = StructType.fromDDL
    assert jdbc.schema_differences(schema("a int, b string, c int"), schema("b string, a long, d int")) == [
        "d: not in the source", "c: not in the target", "a: int for bigint",
        "a: in the place of b", "b: in the place of a",
    ]


def consumer_schema(name):
    """What the consumer's table has: the contract, and the columns it numbers itself."""
    own = "".join(f"{c} bigint, " for c in GENERATED.get(name, ()))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CONTRACTS[name].fields)
    return StructType.fromDDL(own + columns)


def test_the_star_is_exported_as_a_whole(star, monkeypatch):
    written = {}
    monkeypatch.setattr(jdbc, "target_schema", lambda spark, url, name, options: consumer_schema(name))
    monkeypatch.setattr(jdbc, "append_pages", lambda df, url, name, *rest: written.update({name: df.schema}))
    assert export_star(star, "url", {}) == dict.fromkeys(CONTRACTS, 1)
    assert len(written) == 14 and written == dict(CONTRACTS)
    assert sum(len(GENERATED.get(n, ())) for n in CONTRACTS) == 5


def test_nothing_is_exported_if_one_table_does_not_fit(star, monkeypatch):
    written = []
    monkeypatch.setattr(jdbc, "append_pages", lambda *a: written.append(a))
    wrong = {"bridge_adversary_country": StructType.fromDDL("id bigint, other string")}
    monkeypatch.setattr(
        jdbc, "target_schema", lambda spark, url, name, options: wrong.get(name, consumer_schema(name))
    )
    with pytest.raises(ValueError, match="bridge_adversary_country: other: not in the source"):
        export_star(star, "url", {})
    assert written == []


def test_export_checks_before_it_writes(spark, monkeypatch):
    """Without a database: what the export would write, and that it stops on a mismatch."""
    df = spark.range(250_000)
    written = []
    monkeypatch.setattr(jdbc, "target_schema", lambda *_: StructType.fromDDL("id bigint"))
    monkeypatch.setattr(jdbc, "append_pages", lambda *a: written.append(a[4:]))
    jdbc.export_table(df, "url", "t", {})
    jdbc.export_table(df, "url", "t", {}, paged=False)
    assert written == [(3, jdbc.BATCH_SIZE), (1, jdbc.BATCH_SIZE)]
    with pytest.raises(ValueError, match="do not match"):
        jdbc.export_table(df.selectExpr("id AS other"), "url", "t", {})
    assert len(written) == 2


@pytest.fixture(scope="module")
def star(spark):
    return star_of(
        spark,
        reports=[{"id": "1", "country": "Oman", "entity_ids": "E1"}],
        adversaries=[{"adversary_id": "A", "report_ids": "1", "targeted_country": "Oman"}],
        entities=[{"registry_id": "E1"}],
    )


def test_every_exported_table_conforms_to_its_contract(star):
    for name, contract in CONTRACTS.items():
        stored = conform(star[name], contract)
        jdbc.verify_schema(stored.schema, contract)
        assert stored.count() == star[name].count()
        if any(c.endswith("_group_key") for c in stored.columns):
            assert overlong_keys(stored).isEmpty()
    assert len(CONTRACTS["fact_report"]) == 21


def test_conform_refuses_what_does_not_fit(spark):
    contract = StructType.fromDDL("n int")
    with pytest.raises(ArithmeticException):
        conform(spark.createDataFrame([(2**40,)], "n long"), contract).collect()
    with pytest.raises(AnalysisException):
        conform(spark.createDataFrame([(1,)], "m int"), contract)


def test_overlong_keys(spark):
    df = spark.createDataFrame([("x" * 33,), ("x" * 32,)], "a_group_key string")
    assert rows_of(overlong_keys(df), "column", "rows") == [("a_group_key", 1)]


def test_replace_takes_over_column_changes(spark):
    store = TableStore(spark)
    store.replace("t", spark.createDataFrame([(1, "a")], "id int, old string"))
    got = store.replace("t", spark.createDataFrame([(2, 0.5)], "id long, new double"))
    assert got.columns == ["id", "new"] and rows_of(store.read("t"), "id", "new") == [(2, 0.5)]


def test_append_may_read_its_own_table(spark):
    store = TableStore(spark)
    assert store.read_if_exists("t") is None
    rows = store.append("t", spark.createDataFrame([("a", 1)], "d string, id long"), ["d"])
    more = rows.selectExpr("d", "id + 1 AS id")
    assert rows_of(store.append("t", more, ["d"]), "d", "id") == [("a", 1), ("a", 2)]


def test_star_in_a_catalog_schema_is_built_twice_and_loaded(spark):
    spark.sql("CREATE SCHEMA gold")
    store = CatalogStore(spark, "gold")
    for ids in (["1"], ["1", "2"]):
        star_of(
            spark, store,
            reports=[{"id": i, "country": f"C{i}", "entity_ids": "E1|x", "related_groups": "A"} for i in ids],
            adversaries=[{"adversary_id": "A", "report_ids": "1", "targeted_country": "C1"}],
            entities=[{"registry_id": "E1"}],
        )
    star = load_star(CatalogStore(spark, "gold"))
    assert star.unique_report_ids and star.as_of == AS_OF
    assert set(star.tables) == set(STAR_TABLES)
    assert rows_of(star["dim_country"], "id", "country_name") == [
        (-1, "Unknown"), (1, "C1"), (2, "C2"),
    ]
    assert rows_of(weighted_country(star), "country_name", "weighted_reports") == [
        ("C1", 1.0), ("C2", 1.0),
    ]
    views.create_catalog_views(store)
    other = spark.newSession()
    for name, view in views.VIEWS.items():
        stored = other.sql(f"SELECT * FROM gold.{name}")
        lazy = view(star)
        assert sorted(stored.columns) == sorted(lazy.columns)
        assert rows_of(stored, *lazy.columns) == rows_of(lazy, *lazy.columns), name
    spark.sql("DROP SCHEMA gold CASCADE")


def test_shared_folder_is_the_one_the_session_names(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert folder in cut_lineage(spark.range(1)).inputFiles()[0]


def test_build_times_come_from_the_caller(star):
    assert {r[0] for r in star["dim_country"].select("updated_at").collect()} == {AS_OF}


def test_scratch_tables_end_with_their_block(spark):
    from pathlib import Path

    folder = Path(shared_folder(spark)) / "scratch"
    before = set(folder.glob("*")) if folder.exists() else set()
    with scratch_table(spark.range(3)) as table:
        assert table.count() == 3 and len(set(folder.glob("*")) - before) == 1
    assert set(folder.glob("*")) == before
