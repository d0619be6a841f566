from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from reportstar.functions import (
    blank_to_null,
    clean_text,
    first_non_blank,
    group_key,
    labels,
    member_set,
    parse_date,
    parse_timestamp,
    target_country_key,
    tokens,
)
from reportstar.functions.sets import COMMA, PIPE, key_bytes


def column(spark, values, make, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def test_null_words(spark):
    values = [" High ", "NULL", "nul", " Null ", "", "  ", None, "nullable", "\tx"]
    assert column(spark, values, clean_text) == [
        "High", None, None, None, None, None, None, "nullable", "\tx",
    ]


def test_blank_to_null_keeps_null_words(spark):
    assert column(spark, [" a ", " ", None, "NULL"], blank_to_null) == ["a", None, None, "NULL"]


def test_first_non_blank_takes_a_whole_list(spark):
    df = spark.createDataFrame([("a|b", "x"), (" ", "x|y"), (None, None)], "i string, n string")
    got = [r[0] for r in df.select(first_non_blank(F.col("i"), F.col("n"))).collect()]
    assert got == ["a|b", "x|y", None]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-12-31 10:20:30", "2024-12-31 10:20:30"),
        ("2024-12-31", "2024-12-31 00:00:00"),
        ("31/12/2024 10:20:30", "2024-12-31 10:20:30"),
        ("31/12/2024", "2024-12-31 00:00:00"),
        ("12/31/2024", "2024-12-31 00:00:00"),
        ("02/03/2024", "2024-03-02 00:00:00"),
        (" 02/03/2024 ", "2024-03-02 00:00:00"),
        ("12/31/2024 10:20:30", None),
        ("1/2/2024", None),
        ("31/02/2024", None),
        ("45/02/2024", None),
        ("05/00/2024", None),
        ("not-a-date", None),
        ("", None),
        (None, None),
    ],
)
def test_timestamp_formats(spark, text, expected):
    got = column(spark, [text], lambda c: parse_timestamp(c).cast("string"))[0]
    assert got == expected


def test_timestamp_equals_trying_all_formats_in_order(spark):
    rng = random.Random(7)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    pool = [f"{digits(2)}/{digits(2)}/{digits(4)}" for _ in range(300)]
    pool += [f"{rng.randint(0, 32):02}/{rng.randint(0, 13):02}/2024" for _ in range(400)]
    pool += [f"{p} {rng.randint(0, 24):02}:{digits(2)}:{digits(2)}" for p in pool[300:500]]
    pool += [f"{digits(4)}-{digits(2)}-{digits(2)}" for _ in range(200)]
    pool += ["ab/cd/efgh", "//", "1//2024", "01/02/24", "01/02/2024x", "01 02 2024", "2024/01/02"]

    def in_order(c):
        text = F.nullif(F.trim(c), F.lit(""))
        formats = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "MM/dd/yyyy")
        tries = (F.try_to_timestamp(text, F.lit(f)) for f in formats)
        return F.coalesce(F.try_to_timestamp(text), *tries)

    text = lambda parse: lambda c: parse(c).cast("string")
    assert column(spark, pool, text(parse_timestamp)) == column(spark, pool, text(in_order))


def test_date_of_timestamp(spark):
    got = column(spark, ["31/12/2024 23:59:59"], lambda c: parse_date(c).cast("string"))
    assert got == ["2024-12-31"]


def test_tokens_trim_blanks_only_and_keep_repeats(spark):
    values = ["b | a||A", " | ", None, "\tx|y"]
    assert column(spark, values, lambda c: tokens(c, PIPE)) == [
        ["B", "A", "A"], [], [], ["\tX", "Y"],
    ]


def test_tokens_keep_digits_at_the_ends(spark):
    values = ["0a0|1b1|2c2|3d3"]
    assert column(spark, values, lambda c: tokens(c, PIPE)) == [["0A0", "1B1", "2C2", "3D3"]]


def test_separators_differ(spark):
    assert column(spark, ["a,b|c"], lambda c: tokens(c, COMMA)) == [["A", "B|C"]]
    assert column(spark, ["a,b|c"], lambda c: tokens(c, PIPE)) == [["A,B", "C"]]


def test_labels_keep_spelling_and_first_appearance(spark):
    assert column(spark, ["Oman, oman , Qatar,Oman"], lambda c: labels(c, COMMA)) == [
        ["Oman", "oman", "Qatar"]
    ]


def test_member_set(spark):
    values = [["b", "a", "b"], [], None]
    got = column(spark, values, member_set, "array<string>")
    assert got == [["a", "b"], ["UNKNOWN"], ["UNKNOWN"]]


def test_group_key_ignores_order_and_repeats(spark):
    rng = random.Random(3)
    members = ["SUP-1", "SUP-2", "X", "مورد 3"]
    lists = ["|".join(rng.sample(members, 4) + rng.choices(members, k=2)) for _ in range(20)]
    keys = column(spark, lists, lambda c: group_key(member_set(tokens(c, PIPE))))
    assert set(keys) == {md5("|".join(sorted(members)))}


def test_target_key_has_its_own_unknown_and_keeps_repeats(spark):
    values = [None, "", " ", "b|a|b", "|"]
    got = column(spark, values, lambda c: target_country_key(c, tokens(c, PIPE)))
    assert got == [md5("Unknown"), md5("Unknown"), md5(""), md5("A|B|B"), md5("")]


def test_key_bytes_keep_all_keys_apart(spark):
    keys = [None, "", "61", "a", "hot", "0" * 32, "ab" * 16, "AB" * 16, "g" * 32, "0" * 16, "\0" * 16, "0" * 64, "Ü"]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", key_bytes(F.col("k")).alias("b"))
    got = {r["k"]: r["b"] for r in rows.collect()}
    assert got[None] is None and len(set(map(repr, got.values()))) == len(keys)
    assert [k for k, b in got.items() if b is not None and len(b) == 16] == ["0" * 32, "ab" * 16]
