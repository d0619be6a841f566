"""Merkle manifest, hard negatives and host rules against plain Python on small cases."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_small_cases import ODD, documents, words

from reportstar.llm import hard_negatives, host_rules, merkle, queries
from reportstar.llm.columns import bound


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD)


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark, ODD).filter("false")


# Manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(leaves, fanout):
    """Top, and for each leaf the (before, after) of its run on every level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, k in enumerate(at):
            low = k - k % fanout
            paths[i].append(("".join(level[low:k]), "".join(level[k + 1 : low + fanout])))
            at[i] = k // fanout
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], paths


def brute_manifest(rows, fanout=8):
    """rows: (id, group, values)."""
    groups = defaultdict(list)
    for doc, group, values in rows:
        groups[group].append(((doc is not None, doc), brute_leaf(values)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([leaf for _, leaf in sorted(groups[g])], fanout) for g in names}
    root, crown = brute_tree([trees[g][0] for g in names], fanout) if names else (None, [])
    out = Counter()
    for g, above in zip(names, crown, strict=True):
        top, paths = trees[g]
        for ((_, doc), leaf), path in zip(sorted(groups[g]), paths, strict=True):
            steps = [*path, *above]
            out[doc, leaf, top, root, tuple(a for a, _ in steps), tuple(b for _, b in steps)] += 1
    return out


def manifest_of(frame, **more):
    found = merkle.manifest(frame, **more).select("id", "leaf", "subroot", "root", "lefts", "rights").collect()
    return Counter((*r[:4], tuple(r[4]), tuple(r[5])) for r in found)


@pytest.mark.parametrize("fanout, levels", [(8, 2), (2, 3)])
def test_manifest_equals_a_plain_tree(spark, fanout, levels):
    """A third of the rows in one group, one group of a single row, sizes around powers of the fanout."""
    groups = ["hot"] * 700 + ["b"] * 512 + ["c"] * 513 + ["d"] * 8 + ["e"] * 9 + [None] * 64 + [""] * 65 + ["é"]
    rows = [(7 * i % 5000, g, [7 * i % 5000, f"src{i % 3}", g, i, f"text {i}"]) for i, g in enumerate(groups)]
    frame = spark.createDataFrame(
        [(v[0], v[1], v[2], v[3], v[4], "x") for _, _, v in rows],
        "doc_id long, source string, lang string, n_chars long, text string, level_0 string",
    ).repartition(7)
    assert manifest_of(frame, fanout=fanout, levels=levels) == brute_manifest(rows, fanout)


def test_manifest_of_odd_rows(spark, odd, nothing):
    """Null ids, null texts, repeated rows, long texts, clashing columns."""
    frame = odd.withColumn("lang", F.when(F.col("doc_id") > 3, "x")).withColumn("grp", F.lit("clash"))
    rows = [
        (d, "x" if d is not None and d > 3 else None, [d, "x" if d is not None and d > 3 else None, t])
        for d, t, *_ in ODD
    ]
    got = manifest_of(frame, fields=("doc_id", "lang", "text"))
    assert got == brute_manifest(rows)
    assert merkle.manifest(nothing, fields=("doc_id", "text"), group_col="text").count() == 0


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    rows = [(i, "src", "en" if i % 3 else None, 5, f"Text {i}" if i % 5 else f"text {i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    frame.write.parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/tampered/documents.parquet")
    found = queries.op11_merkle(spark, path.rsplit("/", 1)[0]).collect()
    assert {r["doc_id"] for r in found if not r["verified"]} == {
        i for i, *_ in rows if i % 5 and zlib.crc32(str(i).encode()) % 3 == 0
    }
    assert len(found) == 300 and len({r["root"] for r in found}) == 1


# Hard negatives


@pytest.mark.parametrize("shape", [(1, 1, 1), (40, 33, 65), (130, 64, 257), (65, 7, 90), (33, 100, 34)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = rng.integers(-(2**28), 2**28, (m, k)), rng.integers(-(2**28), 2**28, (k, n))
    assert (hard_negatives.strassen(a, b, leaf=8) == a @ b).all()


def brute_negatives(rows, every, k, low=80, high=100, per=100):
    """rows: (id, label, vector), ids unique but for those named in the docstring."""
    sound = [
        (i, label, [int(np.floor(256 * float(x))) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    askers = {}
    for i, label, v in sound:
        if i % every == 0:
            askers[i] = min(askers.get(i, (label, len(v), v)), (label, len(v), v))
    out = Counter()
    for anchor, (label, _, own) in askers.items():
        scored = [
            (-sum(a * b for a, b in zip(own, v, strict=True)), i, other == label)
            for i, other, v in sound
            if i != anchor and len(v) == len(own)
        ]
        scored.sort()
        for p, i, _ in [s for s in scored if s[2]][:k]:
            inside = [s for s in scored if not s[2] and low * -p <= per * -s[0] <= high * -p][:k]
            out.update((anchor, i, rank, n, -p, -s) for rank, (s, n, _) in enumerate(inside, 1))
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("dim", F.lit("x"))


@pytest.mark.parametrize("values", [(2**19, 2**17), (600, 100)])
def test_hard_negatives(spark, values):
    """One label on a third of the rows, equal vectors (ties), odd rows; one cell and many."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(4, 12))
    rows = []
    for i in range(400):
        label = 0 if i % 3 else int(rng.integers(1, 4))
        rows.append((i, label, (centre[label % 2] + rng.normal(size=12) * 0.4).astype(np.float32).tolist()))
    rows += [(1000 + i, i % 2, rows[5][2]) for i in range(40)]
    rows += [
        (2000, 1, rows[1][2][:5]),
        (2001, 1, rows[2][2][:5]),
        (2002, None, rows[2][2]),
        (None, 1, rows[2][2]),
        (2003, 1, None),
        (2004, 1, [float("nan")] * 12),
        (2005, 1, [None] * 12),
        (2006, 1, [float("inf")] * 12),
        (2010, 7, rows[2][2]),
        (2020, 7, []),
    ]
    got = hard_negatives.mine_hard_negatives(
        vectors(spark, rows), every=10, row_values=values[0], anchor_values=values[1]
    )
    assert got.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    want = brute_negatives(rows, 10, 5)
    assert Counter(map(tuple, got.collect())) == want and len(want) > 200


def test_hard_negatives_of_repeated_and_no_rows(spark):
    v = [0.5, 0.25]
    rows = [(0, 1, v), (0, 2, v), (0, 1, v), (1, 1, v), (1, 1, v), (2, 2, v), (2, 2, v)]
    found = hard_negatives.mine_hard_negatives(vectors(spark, rows), every=10).collect()
    assert Counter((r["positive_id"], r["rank"], r["negative_id"]) for r in found) == Counter(
        {(1, 1, 2): 2, (1, 2, 2): 2}
    )
    assert hard_negatives.mine_hard_negatives(vectors(spark, rows).filter("false")).count() == 0
    alone = hard_negatives.mine_hard_negatives(vectors(spark, [(0, 1, v), (1, 2, v)]), every=10)
    assert alone.count() == 0


# Host rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    found = WORD.findall(text)
    where = defaultdict(list)
    for i in range(len(found) - 2):
        where[tuple(found[i : i + 3])].append(i)
    repeated = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines),
        len(lines) - len(set(lines)),
        len(repeated),
    )


TEXTS = [
    "a b c a b c a b c",
    "x x x x",
    "a b a b a b c",
    "one\n\n \t\none\ntwo\r\ntwo\r\none \n",
    "# * $ % & | < > #",
    "\x0b\x0c  é𝔘 \x85 a\x00b",
    "q w e r t y q w",
    "",
]


def test_counts_of_documents(spark, odd, nothing):
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(TEXTS)]]
    frame = odd.select("doc_id", "text").unionByName(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    )
    frame = frame.withColumn("source", F.lit(None).cast("string")).withColumn("verdict", F.lit("clash"))
    judged = host_rules.judge_documents(frame)
    got = Counter((r["record"]["doc_id"], *[r[c] for c in host_rules.COUNTS]) for r in judged.collect())
    assert got == Counter((d, *brute_counts(t or "")) for d, t, *_ in rows)
    assert judged.select("record.*").columns == frame.columns
    assert host_rules.judge_documents(frame.filter("false")).count() == 0


@pytest.mark.parametrize(
    "code", [F.xxhash64, lambda *w: F.lit(7).cast("long"), lambda *w: F.xxhash64(w[0])], ids=["hash", "one", "weak"]
)
def test_repeated_words_whatever_the_code(spark, code):
    texts = [*TEXTS, words(300, 1, 6), words(200, 2, 2), words(900, 3, 30)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = F.regexp_extract_all("text", F.lit(host_rules.WORD), F.lit(0))
    counted = frame.select("text", bound(found, lambda w: host_rules.repeated_words(w, code)).alias("n"))
    assert {r["text"]: r["n"] for r in counted.collect()} == {t: brute_counts(t)[5] for t in texts}


def test_verdicts_of_hosts(spark):
    """A hot clean host, a watched one, a junk one, a small host that one bad document does not condemn, and no host."""
    good, short, symbols = words(80, 1), "few words", words(60, 2) + " #" * 9
    rows = [("hot", good)] * 400 + [("mixed", good)] * 80 + [("mixed", symbols)] * 20
    rows += [("junk", short)] * 95 + [("junk", good)] * 5 + [("small", short)] + [(None, good)] * 40
    rows += [(f"other{i % 20}", good) for i in range(600)]
    rows = [(i, s, f"{t} {i}") for i, (s, t) in enumerate(rows)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    limits = host_rules.Limits(blocked=0.93)
    measured = host_rules.measure_documents(frame, limits)
    verdicts = {r["host"]: r for r in host_rules.host_verdicts(measured, limits).collect()}
    assert {h: v["verdict"] for h, v in verdicts.items() if "other" not in (h or "")} == {
        "hot": "trusted", "mixed": "watched", "junk": "blocked", "small": "watched", None: "trusted"
    }
    assert verdicts["mixed"]["failures"]["symbols"] == 20 and verdicts["junk"]["failures"]["base"] == 95
    assert 0 < verdicts[None]["rate"] < 0.02 and verdicts["small"]["rate"] < 0.93
    kept = {r["record"]["doc_id"] for r in host_rules.judge_documents(frame, limits).filter("kept").collect()}
    assert kept == {i for i, s, t in rows if s not in ("junk", "small") and "#" not in t}


def test_hosts_that_are_alike_share_the_mean(spark):
    hosts = spark.createDataFrame([("a", 100, 10), ("b", 50, 5)], "host string, docs long, bad long")
    assert host_rules.beta_prior(hosts) == (0.1, None)
    assert host_rules.beta_prior(hosts.filter("false")) == (0.0, None)
    mean, strength = host_rules.beta_prior(
        spark.createDataFrame([("a", 100, 0), ("b", 100, 100)], "host string, docs long, bad long")
    )
    assert mean == 0.5 and strength == pytest.approx(0, abs=1e-9)
