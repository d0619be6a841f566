"""Co-training: all unlabelled rows teach, wherever they are."""

from __future__ import annotations

import numpy as np
import pytest
from test_small_cases import documents, labelled_corpus

from reportstar.llm import cotraining


def test_sure_rows_teach_however_many_are_surer():
    """Rows of a rare layout (the last column of metadata) are sure, but thousands of others are surer."""
    rng = np.random.default_rng(0)
    size, rare = 10_000, 200
    y = np.arange(size) % 2
    content = (2 * y[:, None] - 1) * 8 + rng.normal(size=(size, 3))
    metadata = np.hstack([rng.normal(size=(size, 2)) + 2 * y[:, None], np.zeros((size, 1))])
    content[-rare:] = 4
    metadata[-rare:] = [1, 1, 3]
    model = cotraining.co_train((content[:400], metadata[:400]), y[:400], (content[400:], metadata[400:]))
    plain, of_rare = np.array([[1.0, 1.0, 0.0]]), np.array([[1.0, 1.0, 3.0]])
    middle = np.zeros((1, 3))
    assert model.score(middle, of_rare)[0, 1] > model.score(middle, plain)[0, 1] + 0.2


def test_sums_of_many_tasks_are_those_of_all_rows(spark):
    rows, labels = labelled_corpus(spark)
    rows += [(None, rows[1][1]), rows[3]]
    docs = documents(spark, rows).repartition(7)
    model = cotraining.fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"), labelled_rows=300)
    frame = docs.toPandas()
    frame["text"] = [t.encode() for t in frame["text"]]
    seen = []
    whole = cotraining.co_train

    def spied(labelled, y, pool):
        seen.append((labelled, y))
        return whole(labelled, y, pool)

    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(cotraining, "co_train", spied)
        cotraining.fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"), labelled_rows=300)
    (labelled, y), = seen
    content, metadata = cotraining.views(frame)
    own = {row.tobytes() for row in labelled[0]}
    other = np.array([row.tobytes() not in own or i is None or np.isnan(i) for row, i in zip(content, frame["doc_id"])])
    assert len(y) == 300 and other.sum() == len(rows) - 300
    want = cotraining.co_train(labelled, y, (content[other], metadata[other]))
    np.testing.assert_allclose(model.content, want.content, rtol=1e-5, atol=1e-7)
    np.testing.assert_allclose(model.metadata, want.metadata, rtol=1e-5, atol=1e-7)


def test_descent_arrives_where_the_slope_is_flat():
    """On rows that can be told apart, where whole Newton steps overshoot."""
    rng = np.random.default_rng(1)
    y = np.arange(500) % 2
    x = rng.normal(size=(500, 40)) + 3 * y[:, None]
    w = cotraining.logistic(x, y, 0.05)
    slope = cotraining.loss_and_slope(x, y, w)[1:] + cotraining.penalty(w, 0.05) * w
    gap = slope @ np.linalg.solve(cotraining.curvature(x, w) + np.diag(cotraining.penalty(w, 0.05)), slope)
    assert gap <= 4 * cotraining.GAP * len(y)


def test_a_large_pool_does_not_outvote_the_labels():
    """Thousands of sure rows of one class weigh no more than the labelled rows of that class."""
    rng = np.random.default_rng(2)
    y = np.arange(200) % 2
    view = lambda y: rng.normal(size=(len(y), 2)) + 3 * y[:, None]
    labelled = (view(y), view(y))
    goods = np.ones(20_000, int)
    small = cotraining.co_train(labelled, y, (view(goods[:200]), view(goods[:200])))
    large = cotraining.co_train(labelled, y, (view(goods), view(goods)))
    held = np.arange(400) % 2
    parts = (view(held), view(held))
    for model in (small, large):
        assert ((model.score(*parts)[:, 2] >= 0.5) == held).mean() > 0.97


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_the_pool_does_no_harm(spark, size):
    """Held-out accuracy with the pool against that without it."""
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").filter("doc_id < 4000").toPandas()
    labels = spark.read.parquet(f"/root/testdata/{size}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    docs["text"] = [t.encode() for t in docs["text"]]
    content, metadata = cotraining.views(docs)
    quality = docs["doc_id"].map(labels).to_numpy()
    known, held = ~np.isnan(quality) & (docs["doc_id"] % 5 > 0), ~np.isnan(quality) & (docs["doc_id"] % 5 == 0)
    y = quality[known].astype(int)
    labelled = (content[known], metadata[known])
    right = []
    for pool in (np.zeros(len(docs), bool), ~known):
        model = cotraining.co_train(labelled, y, (content[pool], metadata[pool]))
        right.append(((model.score(content[held], metadata[held])[:, 2] >= 0.5) == quality[held]).mean())
    assert right[1] >= right[0] - 0.01 and right[1] >= 0.95
