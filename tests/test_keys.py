from __future__ import annotations

import random
from datetime import datetime

from conftest import AS_OF, rows_of, star_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from reportstar.operators.numbering import number_rows
from reportstar.plans.keys import register
from reportstar.sinks.store import TableStore

LATER = datetime(2026, 1, 2)


def test_numbering_equals_a_global_row_number(spark):
    rng = random.Random(1)
    values = [(f"k{rng.randint(0, 10**6)}", i) for i in range(5000)]
    values += [(None, 5000), (None, 5001), ("", 5002)]
    # A third of all rows share one key.
    values += [("hot", i) for i in range(6000, 8500)]
    df = spark.createDataFrame(values, "k string, tie int").repartition(7)
    got = number_rows(df, ["k", "tie"], "id")
    expected = df.withColumn("id", F.row_number().over(Window.orderBy("k", "tie")))
    assert rows_of(got, "id", "k", "tie") == rows_of(expected, "id", "k", "tie")


def test_numbering_restarts_per_group(spark):
    rows = [(f"d{i % 3}", f"{i * 7919 % 1000:04}") for i in range(1000)]
    df = spark.createDataFrame(rows, "d string, k string").repartition(5)
    got = number_rows(df, ["k"], "id", within="d")
    window = Window.partitionBy("d").orderBy("k")
    expected = df.withColumn("id", F.row_number().over(window))
    assert rows_of(got, "d", "k", "id") == rows_of(expected, "d", "k", "id")


def test_numbering_of_nothing(spark):
    assert number_rows(spark.createDataFrame([], "k string"), ["k"], "id").count() == 0


def candidates(spark, rows):
    return spark.createDataFrame(rows, "dimension string, natural_key string, label string")


def test_known_keys_keep_id_label_and_first_seen(spark):
    first = register(
        candidates(spark, [("a", "K1", "k1"), ("a", "K3", "K3"), ("b", "K1", "K1")]), None, AS_OF
    )
    again = candidates(
        spark, [("a", "K0", "k0"), ("a", "K1", "K1"), ("a", "K2", "k2"), ("c", "K", "k")]
    )
    new = register(again, first, LATER)
    assert rows_of(first, "dimension", "natural_key", "label", "id") == [
        ("a", "K1", "k1", 1), ("a", "K3", "K3", 2), ("b", "K1", "K1", 1),
    ]
    assert rows_of(new, "dimension", "natural_key", "label", "id") == [
        ("a", "K0", "k0", 3), ("a", "K2", "k2", 4), ("c", "K", "k", 1),
    ]
    assert {r[0] for r in new.select("first_seen_at").collect()} == {LATER}


def test_candidates_over_the_pipeline(spark):
    star = star_of(
        spark,
        reports=[
            {"id": "1", "classification": "Secret", "country": "Oman, qatar"},
            {"id": "2", "classification": "SECRET", "country": "OMAN,Unknown"},
            {"id": "3", "classification": "unknown", "threat_type": "NULL"},
        ],
        adversaries=[
            {"adversary_id": "apt-1", "targeted_country": "Yemen|oman"},
            {"adversary_id": None},
        ],
    )
    # Upper case sorts first; 'Unknown' and NULL keys are not registered.
    assert rows_of(star["dim_key"], "dimension", "natural_key", "label", "id") == [
        ("adversary", "APT-1", "apt-1", 1),
        ("classification", "SECRET", "SECRET", 1),
        ("country", "OMAN", "OMAN", 1),
        ("country", "QATAR", "qatar", 2),
        ("country", "YEMEN", "YEMEN", 3),
    ]


def test_second_run_of_the_pipeline(spark):
    store = TableStore(spark)
    star_of(
        spark,
        store,
        reports=[{"id": "1", "threat_type": "m"}],
        entities=[
            {"registry_id": "e1", "name_en": "Gone"},
            {"registry_id": "e2", "name_en": "Stays"},
        ],
    )
    star = star_of(
        spark,
        store,
        LATER,
        reports=[{"id": "1", "threat_type": "a"}, {"id": "2", "threat_type": "M"}],
        entities=[
            {"registry_id": "e2", "name_en": "Stays"},
            {"registry_id": "e0", "name_en": "New"},
        ],
    )
    # A key whose source row vanished keeps its id and label.
    assert rows_of(star["dim_entity"], "id", "registry_id", "name_en", "is_registered") == [
        (-1, None, "Unknown", False),
        (1, None, "E1", False),
        (2, "e2", "Stays", True),
        (3, "e0", "New", True),
    ]
    # The first spelling stays for good, so the new one is not found by the fact.
    assert rows_of(star["dim_threat_type"], "id", "threat_type_name") == [
        (-1, "Unknown"), (1, "m"), (2, "a"),
    ]
    assert rows_of(star["fact_report"], "report_id", "threat_type_id") == [("1", 2), ("2", -1)]
    assert star["dim_key"].groupBy("dimension", "natural_key").count().filter("count > 1").isEmpty()
