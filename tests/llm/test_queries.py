"""The registered queries on the smallest test data: against SQL where there is any, the rest and the pipeline's stages
against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_small_cases import brute_classes, brute_repeats

import __spark_entry__ as contract
import corpus_pipeline
from check import compare, connect
from reportstar.llm import cotraining, packing, queries, sql


@pytest.fixture(scope="module")
def db():
    return connect(contract.SMOKE_DIR)


@pytest.fixture(scope="module")
def documents(db):
    return db.sql("SELECT doc_id, text, lang, source, n_chars FROM documents").fetchall()


def test_every_operator_is_registered_once():
    numbers = Counter(name.split("_")[0] for name in contract.queries() if name.startswith("op"))
    assert numbers == {f"op{n}": 1 for n in range(1, 14)}
    assert "pipeline" in contract.queries() and sql.ORACLE_SQL.keys() <= queries.QUERIES.keys()


@pytest.mark.parametrize("name", sorted(sql.ORACLE_SQL))
def test_query_equals_its_sql(spark, db, name):
    assert compare(spark, db, contract.SMOKE_DIR, name) == ""


def test_suffix_array_dedup(spark, documents):
    got = queries.op7_suffix_array_dedup(spark, contract.SMOKE_DIR).collect()
    want = brute_repeats([(d, t) for d, t, *_ in documents], 50, False)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got) == Counter(
        {k[:4]: n for k, n in want.items()}
    )


def test_near_dedup(spark, documents):
    got = queries.op5_near_dedup(spark, contract.SMOKE_DIR).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes([(d, t) for d, t, *_ in documents])


def test_quality_agrees_with_the_labels(spark, db):
    """On all labelled documents of a table that is larger than the sample it is fitted on would be weak; here a fifth
    of the labels is held out by id."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = cotraining.fit_quality(docs, labels.filter("doc_id % 5 > 0"))
    held = labels.filter("doc_id % 5 = 0").toPandas().set_index("doc_id")["quality"]
    scored = {r["record"]["doc_id"]: r["p_good"] >= 0.5 for r in cotraining.score_quality(docs, model).collect()}
    right = [scored[d] == bool(q) for d, q in held.items()]
    clean = [scored[d] for d, q in held.items() if q]
    assert len(right) > 60 and np.mean(right) >= 0.95 and np.mean(clean) >= 0.97


def test_packing_is_nearly_full(spark, documents):
    rows = queries.op3_packing(spark, contract.SMOKE_DIR).collect()
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= 1.02 * total / 1024 + 1
    encode = queries.byte_bpe()
    sizes = Counter()
    for r in rows:
        sizes[r["doc_id"]] += r["length"]
    assert sizes == {d: len(encode([t])[0]) + 1 for d, t, *_ in documents}


def test_stages_of_the_pipeline(spark, tmp_path):
    """Each stage on what the one before kept, written and read again."""
    kept = spark.read.parquet(f"{contract.SMOKE_DIR}/documents.parquet")
    columns = kept.columns
    inputs = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        inputs[name] = kept.toPandas()
        out = stage(spark, kept, contract.SMOKE_DIR)
        if k < 4:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        kept = spark.read.parquet(str(tmp_path / str(k)))
    last = kept.toPandas()

    start = inputs["quality classifier"]
    labels = spark.read.parquet(f"{contract.SMOKE_DIR}/labels.parquet")
    docs = spark.read.parquet(f"{contract.SMOKE_DIR}/documents.parquet")
    model = cotraining.fit_quality(docs, labels)
    content, metadata = cotraining.views(start.assign(text=[t.encode() for t in start["text"]]))
    good = model.score(content, metadata)[:, 2] >= 0.5
    exact_in = inputs["exact dedup"]
    assert set(exact_in["doc_id"]) == set(start["doc_id"][good])
    largest = exact_in.groupby("text")["doc_id"].max()
    near_in = inputs["near dedup"]
    assert sorted(near_in["doc_id"]) == sorted(largest)
    label = brute_classes(list(zip(near_in["doc_id"].tolist(), near_in["text"], strict=True)))
    mix_in = inputs["source mixing"]
    assert sorted(mix_in["doc_id"]) == sorted(set(label.values()))
    pack_in = inputs["packing"]
    with duckdb.connect() as own:
        own.register("documents", mix_in)
        mixed = own.sql(sql.MIXING).df()
    assert Counter(pack_in["doc_id"]) == Counter(mixed["doc_id"])
    encode = queries.byte_bpe()
    want = Counter()
    for doc, text in zip(pack_in["doc_id"].tolist(), pack_in["text"], strict=True):
        tokens = [*encode([text])[0], packing.END]
        want.update((doc, tuple(tokens[a : a + n])) for a, n in packing.cut(len(tokens), 1024))
    assert Counter((d, tuple(t)) for d, t in zip(last["doc_id"].tolist(), last["tokens"], strict=True)) == want
    held = defaultdict(int)
    for s, n in zip(last["sequence_id"], last["length"], strict=True):
        held[s] += n
    assert max(held.values()) <= 1024
