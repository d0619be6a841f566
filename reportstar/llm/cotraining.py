"""Quality classifier by co-training.

Two views of a document have a classifier each: its content (byte trigrams of the whole text, and how often
words repeat), and its metadata (source, language, recorded length, layout of the page). Each round the two
label the unlabelled documents they are most sure of for one another. Both are then calibrated on labelled
documents that took no part, and the calibrated views are combined to score every document.

Labelled documents are a bounded sample, `labelled_rows` drawn by a hash of the id. The unlabelled ones are all others:
each round scores them all, and all that a view, calibrated, is sure of teach the other view. Their losses and slopes are
summed where they are; only the sums reach the driver, which descends until the loss is as low as it gets. A very long
text costs its own memory, once for each pass over the texts (two). Every document is scored.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.sinks.store import cut_lineage, scratch_table

STEPS, GAP = 32, 1e-5  # sums over the pool in a round at most; loss a row that may be left on the table
BUCKETS = 16
TRIGRAMS = 512
LANGS, SOURCES = 16, 64
CONTENT = TRIGRAMS + 4
METADATA = LANGS + SOURCES + 9
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True


def content_view(raw: bytes) -> np.ndarray:
    padded = np.frombuffer(raw if len(raw) > 2 else raw.ljust(3), np.uint8).astype(np.uint32)
    grams = (padded[:-2] << 16) | (padded[1:-1] << 8) | padded[2:]
    counts = np.bincount((grams * np.uint32(2654435761)) >> np.uint32(23), minlength=TRIGRAMS)
    share = counts / counts.sum()
    words = raw.split()
    seen = share[share > 0]
    extra = (
        len(set(words)) / max(1, len(words)),
        -(seen * np.log(seen)).sum() / np.log(TRIGRAMS),
        share.max(),
        np.log1p(len(words)) / 10,
    )
    return np.concatenate([np.sqrt(share), extra]).astype(np.float32)


def metadata_view(raw: bytes, lang: str | None, source: str | None, n_chars: float | None) -> np.ndarray:
    out = np.zeros(METADATA, np.float32)
    out[zlib.crc32((lang or "").encode()) % LANGS] = 1
    out[LANGS + zlib.crc32((source or "").encode()) % SOURCES] = 1
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(1, len(raw))
    lines = raw.count(b"\n") + 1
    blanks, letters = kinds[BLANK].sum(), kinds[LETTER].sum()
    known = n_chars is not None and np.isfinite(n_chars) and n_chars >= 0
    out[LANGS + SOURCES :] = (
        np.log1p(n_chars) / 10 if known else 0,
        0 if known else 1,
        np.log1p(lines) / 5,
        np.log1p(size / lines) / 10,
        kinds[UPPER].sum() / max(1, letters),
        kinds[DIGIT].sum() / size,
        (size - blanks - letters - kinds[DIGIT].sum()) / size,
        blanks / size,
        np.log1p(size / (blanks + 1)) / 5,
    )
    return out


def views(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Content and metadata of the rows (text as bytes, lang, source, n_chars)."""
    lengths = pd.to_numeric(frame["n_chars"], errors="coerce")
    content = [content_view(t) for t in frame["text"]]
    metadata = [
        metadata_view(t, a if isinstance(a, str) else None, b if isinstance(b, str) else None, n)
        for t, a, b, n in zip(frame["text"], frame["lang"], frame["source"], lengths, strict=True)
    ]
    # As they are stored between the passes of a fit.
    return (
        np.array(content, np.float16).astype(np.float32).reshape(-1, CONTENT),
        np.array(metadata, np.float16).astype(np.float32).reshape(-1, METADATA),
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def loss_and_slope(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over the rows: the logistic loss at `w`, then its slope (the last weight is the constant)."""
    out = np.zeros(len(w) + 1)
    for at in range(0, len(x), 1000):  # in blocks, so that memory is the rows themselves
        part, label = x[at : at + 1000].astype(np.float64), y[at : at + 1000]
        z = logits(part, w)
        out[0] += np.logaddexp(0, np.where(label > 0, -z, z)).sum()
        gap = sigmoid(z) - label
        out[1:-1] += gap @ part
        out[-1] += gap.sum()
    return out


def spread(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Diagonal of the curvature."""
    out = np.zeros(len(w))
    for at in range(0, len(x), 1000):
        part = x[at : at + 1000].astype(np.float64)
        p = sigmoid(logits(part, w))
        share = np.maximum(p * (1 - p), 1e-2)
        out[:-1] += share @ part**2
        out[-1] += share.sum()
    return out


def curvature(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    out = np.zeros((len(w), len(w)))
    for at in range(0, len(x), 1000):
        part = np.hstack([x[at : at + 1000].astype(np.float64), np.ones((len(x[at : at + 1000]), 1))])
        p = sigmoid(part @ w)
        part *= np.sqrt(np.maximum(p * (1 - p), 1e-4))[:, None]
        out += part.T @ part
    return out


def penalty(w: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge of each weight, next to none on the constant."""
    out = np.full(len(w), ridge)
    out[-1] = 1e-6
    return out


class Descent:
    """Quasi-Newton descent of a convex loss that is summed elsewhere: `trial` is where it wants to know the loss next,
    `take` tells it. A step is halved until the loss falls. `start` is the curvature that it begins with; what later
    slopes tell of the curvature is added to it. It has arrived when the loss can fall by no more than about GAP a row."""

    def __init__(self, w: np.ndarray, start: np.ndarray, rows: float):
        self.w, self.trial, self.gap = w, w, GAP * rows
        self.solve = np.linalg.inv(start)
        self.loss, self.slope, self.move = np.inf, None, None
        self.share = 1.0
        self.seen: list[tuple[np.ndarray, np.ndarray]] = []
        self.arrived = False

    def take(self, loss: float, slope: np.ndarray) -> None:
        if self.slope is not None:
            promised = self.share * (self.slope @ self.move)
            if loss > self.loss + 1e-4 * promised:
                self.share /= 2
                self.trial = self.w + self.share * self.move
                self.arrived = abs(promised) <= self.gap / 10
                return
            step, change = self.trial - self.w, slope - self.slope
            if step @ change > 0:
                self.seen.append((step, change))
        self.w, self.loss, self.slope, self.share = self.trial, loss, slope, 1.0
        self.move = -self._turned(slope)
        self.arrived = -(slope @ self.move) <= 2 * self.gap
        self.trial = self.w + self.move

    def _turned(self, slope: np.ndarray) -> np.ndarray:
        """The slope times the inverse of the curvature as known so far."""
        left, shares = slope.copy(), []
        for step, change in reversed(self.seen):
            shares.append((step @ left) / (step @ change))
            left = left - shares[-1] * change
        out = self.solve @ left
        for (step, change), share in zip(self.seen, reversed(shares), strict=True):
            out = out + step * (share - (change @ out) / (step @ change))
        return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 60) -> np.ndarray:
    """Weights (the last is the constant) of a ridge logistic regression on rows that are here."""
    w = np.zeros(x.shape[1] + 1)
    own = penalty(w, ridge)
    while True:
        descent = Descent(w, curvature(x, w) + np.diag(own), len(x))
        for _ in range(8):  # then begin with the curvature found here
            total = loss_and_slope(x, y, descent.trial)
            descent.take(total[0] + (own * descent.trial**2).sum() / 2, total[1:] + own * descent.trial)
            if descent.arrived:
                return descent.w
        w, steps = descent.w, steps - 8
        if steps <= 0:
            warnings.warn("a logistic regression has not converged", stacklevel=2)
            return w


def logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass(frozen=True)
class Model:
    """Weights of the views, their calibrations, and the weights of the calibrated views together."""

    content: np.ndarray
    metadata: np.ndarray
    calibrated: tuple[np.ndarray, np.ndarray]
    combined: np.ndarray

    def score(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Columns: probability of good quality by content, by metadata, and by both."""
        each = np.stack(
            [
                logits(logits(x, w)[:, None], c)
                for x, w, c in zip((content, metadata), (self.content, self.metadata), self.calibrated, strict=True)
            ],
            axis=1,
        )
        both = logits(each, self.combined)
        return sigmoid(np.column_stack([each, both]))


def constant(probability: float) -> Model:
    same = np.array([0.0, np.log(probability / (1 - probability))])
    return Model(
        np.zeros(CONTENT + 1), np.zeros(METADATA + 1), (same, same), np.array([0.5, 0.5, 0.0])
    )


Views = tuple[np.ndarray, np.ndarray]
#: Rows of the pool that the last teachers moved; by view, for bad and good rows: how many, their loss, its slope and the diagonal of
#: its curvature.
Taught = tuple[int, list[np.ndarray]]


def taught(pool: Views, teachers: list[Views], weights: Views, sure: float) -> Taught:
    """What the rows of `pool` teach at `weights`. `teachers`: both views' weights of each round so far; the first round
    in which a view is `sure` of a row labels it for the other view and takes it out of the pool. A row's label
    follows from these weights alone, so none is stored."""
    left = np.ones(len(pool[0]), bool)
    moved = np.zeros(len(left), bool)
    label = np.full((2, len(left)), -1)
    sides = [np.stack([each[k] for each in teachers], axis=1) for k in (0, 1)]
    good = [sigmoid(logits(x, w)) for x, w in zip(pool, sides, strict=True)]  # rows x rounds
    for k in range(len(teachers)):
        moved = np.zeros(len(left), bool)
        for teacher, learner in ((0, 1), (1, 0)):
            p = good[teacher][:, k]
            certain = left & (np.maximum(p, 1 - p) >= sure)
            label[learner][certain] = p[certain] >= 0.5
            moved |= certain
        left &= ~moved
    found = []
    for k in (0, 1):
        sums = np.zeros((2, 2 * len(weights[k]) + 2))
        for kind in (0, 1):
            rows = pool[k][label[k] == kind]
            losses = loss_and_slope(rows, np.full(len(rows), kind), weights[k])
            sums[kind] = [len(rows), *losses, *spread(rows, weights[k])]
        found.append(sums)
    return int(moved.sum()), found


def calibration(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Slope and constant that turn the logits of `w` into those of a probability."""
    return logistic(logits(x, w)[:, None], y, 0.01)


def calibrated_weights(w: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = w * c[0]
    out[-1] += c[1]
    return out


def co_train(
    labelled: Views,
    y: np.ndarray,
    pool: Views | Callable[[list[Views], Views, float], Taught],
    rounds: int = 4,
    sure: float = 0.97,
    ridge: float = 0.05,
    pseudo: float = 1.0,
) -> Model:
    """Fit both views; every fifth labelled row is held out for calibration.

    `pool`: the unlabelled rows, or a function that gives `taught` of them wherever they are. A round moves all its rows
    that a view, calibrated, is at least `sure` of to the other view's training rows. The moved rows of a class weigh
    together `pseudo` times its labelled rows, or one each if that is less, so that labels keep their say however large
    the pool is. Rows of one class only: a constant; none: one half.
    """
    if len(np.unique(y)) < 2:
        return constant(0.5 if not len(y) else 0.99 if y[0] else 0.01)
    teach = pool if callable(pool) else partial(taught, pool)
    held = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[held])) < 2 or len(np.unique(y[~held])) < 2:
        held[:] = True  # too few rows to hold any out
        train = held
    else:
        train = ~held
    own, mine = [v[train] for v in labelled], y[train]
    weights = tuple(logistic(x, mine, ridge) for x in own)
    calibrated = [calibration(labelled[k][held], y[held], weights[k]) for k in (0, 1)]
    teachers: list[Views] = []
    for _ in range(rounds):
        teachers.append(tuple(calibrated_weights(w, c) for w, c in zip(weights, calibrated, strict=True)))
        moved, sums = teach(teachers, weights, sure)
        if not moved:
            break

        def shares(k: int) -> np.ndarray:
            """What one moved row of each class weighs."""
            rows = np.maximum(sums[k][:, 0], 1)
            return np.minimum(1.0, pseudo * np.bincount(mine, minlength=2) / rows)

        descents = []
        for k, w in enumerate(weights):
            start = curvature(own[k], w) + np.diag(shares(k) @ sums[k][:, 2 + len(w) :] + penalty(w, ridge))
            descents.append(Descent(w, start, len(mine) + shares(k) @ sums[k][:, 0]))
        for left in range(STEPS - 1, -1, -1):
            for k, descent in enumerate(descents):
                if not descent.arrived:
                    at = descent.trial
                    total = loss_and_slope(own[k], mine, at) + shares(k) @ sums[k][:, 1 : 2 + len(at)]
                    own_share = penalty(at, ridge)
                    descent.take(total[0] + (own_share * at**2).sum() / 2, total[1:] + own_share * at)
            if all(d.arrived for d in descents) or not left:
                break
            _, sums = teach(teachers, tuple(d.w if d.arrived else d.trial for d in descents), sure)
        if not all(d.arrived for d in descents):
            warnings.warn("a round of co-training has not converged", stacklevel=2)
        weights = tuple(d.w for d in descents)
        calibrated = [calibration(labelled[k][held], y[held], weights[k]) for k in (0, 1)]
    each = np.stack(
        [logits(logits(labelled[k][held], weights[k])[:, None], calibrated[k]) for k in (0, 1)], axis=1
    )
    return Model(weights[0], weights[1], tuple(calibrated), logistic(each, y[held], 0.01))


def _split(features: list[bytes]) -> Views:
    joined = np.frombuffer(b"".join(features), np.float16).reshape(-1, CONTENT + METADATA).astype(np.float32)
    return joined[:, :CONTENT], joined[:, CONTENT:]


def taught_by(pool: DataFrame, teachers: list[Views], weights: Views, sure: float) -> Taught:
    """`taught` of all rows of `pool` (features). Each task sums its rows, some 20 KB; the sums of the tasks are added in
    BUCKETS groups, so that the driver gets as many whatever the number of tasks."""
    schema = pa.schema([("bucket", pa.int32()), ("sums", pa.binary())])
    sizes = [2 * (2 * len(w) + 2) for w in weights]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + sum(sizes))
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = batch["features"].slice(at, 2000).to_pylist()
                moved, found = taught(_split(rows), teachers, weights, sure)
                total += np.concatenate([[moved], found[0].ravel(), found[1].ravel()])
        bucket = TaskContext.get().partitionId() % BUCKETS
        yield pa.record_batch([pa.array([bucket], pa.int32()), [total.tobytes()]], schema=schema)

    def added(group: pa.Table) -> pa.Table:
        total = added_up(group["sums"].to_pylist())
        return pa.table([group["bucket"].slice(0, 1), pa.array([total.tobytes()], pa.binary())], schema=schema)

    found = (
        pool.select("features")
        .mapInArrow(summed, "bucket int, sums binary")
        .groupBy("bucket")
        .applyInArrow(added, "bucket int, sums binary")
        .collect()
    )
    total = added_up([r["sums"] for r in found]) if found else np.zeros(1 + sum(sizes))
    views_ = np.split(total[1:], [sizes[0]])
    return int(total[0]), [v.reshape(2, -1) for v in views_]


def added_up(sums: list[bytes]) -> np.ndarray:
    """Sorted, so that the sum does not depend on the order in which tasks end."""
    return np.sort(np.stack([np.frombuffer(s, np.float64) for s in sums]), axis=0).sum(axis=0)


def _features(docs: DataFrame, text_col: str, lang_col: str, source_col: str, length_col: str) -> list[Column]:
    return [
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
        F.col(length_col).cast("double").alias("n_chars"),
    ]


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    labelled_rows: int = 8000,
    id_col: str = "doc_id",
    label_col: str = "quality",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    length_col: str = "n_chars",
) -> Model:
    """Model of `label_col` (1 good, 0 bad). Of contradicting labels of one id the mean decides, a tie is good.
    Labels that are null, or of no document, are left out. Every other row of `docs` is in the pool, repeated rows
    and rows without an id too, and so are documents with a label beyond `labelled_rows`, without it."""
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    )
    by_chance = F.xxhash64("id")
    ids = docs.select(F.col(id_col).alias("id")).filter("id IS NOT NULL").distinct()
    # Bounded by the parameter above, whatever the size of the tables.
    drawn = cut_lineage(known.join(ids, "id", "left_semi").orderBy(by_chance, "id").limit(labelled_rows))
    texts = docs.select(
        F.col(id_col).alias("id"), *_features(docs, text_col, lang_col, source_col, length_col)
    ).join(F.broadcast(drawn), "id", "left")

    def described(batches):
        for frame in batches:
            content, metadata = views(frame)
            joined = np.hstack([content, metadata]).astype(np.float16)
            yield pd.DataFrame(
                {"id": frame["id"], "label": frame["label"], "features": [row.tobytes() for row in joined]}
            )

    # Stored once, until the model is there: every step of every round reads them.
    with scratch_table(texts.mapInPandas(described, "id long, label int, features binary")) as rows:
        known_rows = rows.filter("label IS NOT NULL").groupBy("id", "label").agg(F.min("features").alias("features"))
        first = known_rows.toPandas().sort_values("id")  # repeated rows teach once
        first = first.iloc[np.argsort([zlib.crc32(str(i).encode()) for i in first["id"]], kind="stable")]
        labelled = _split(first["features"].tolist())
        pool = rows.filter("label IS NULL")
        return co_train(labelled, first["label"].to_numpy(np.int64), partial(taught_by, pool))


def score_quality(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    length_col: str = "n_chars",
) -> DataFrame:
    """Each row of `docs` as `record`, with p_content, p_metadata, p_good.

    Null and empty texts are scored as texts without a trigram but blanks; nulls in other columns are values of
    their own. Repeated rows get the same score. No rows: no rows.
    """

    @F.pandas_udf("p_content double, p_metadata double, p_good double")
    def scored(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        frame = pd.DataFrame({"text": text, "lang": lang, "source": source, "n_chars": n_chars})
        p = model.score(*views(frame))
        return pd.DataFrame({"p_content": p[:, 0], "p_metadata": p[:, 1], "p_good": p[:, 2]})

    features = _features(docs, text_col, lang_col, source_col, length_col)
    # Said to be nondeterministic so that a filter on the score does not compute it a second time.
    score = scored.asNondeterministic()(*features).alias("score")
    record = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record")
    return docs.select(record, score).select("record", "score.*")
