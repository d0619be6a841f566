"""Hard negatives by exact integer scores.

Anchors are a stated set (ids divisible by `every`), scored against all rows in cells: a bounded chunk of anchors
against a bounded part of the rows. A cell multiplies int64 tiles by Strassen's recursion and keeps a heap of the
best positives of each anchor; heaps of all cells are merged. The scores of the positives open the windows in which
a second sweep of cells looks for negatives, with a heap for each window, merged likewise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportstar.llm.topk import LOWEST, NOBODY
from reportstar.sinks.store import cut_lineage

LEAF, TILE = 32, 1024
POSITIVES = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
NEGATIVES = pa.schema(
    [
        ("anchor_id", pa.int64()),
        ("place", pa.int32()),
        ("positive_id", pa.int64()),
        ("positive_score", pa.int64()),
        ("negative_id", pa.int64()),
        ("negative_score", pa.int64()),
    ]
)


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b of int64, with seven products of half the size for eight; odd sides get a line of zeros.

    Sums wrap modulo 2^64 on the way, so the result is exact wherever it fits 64 bits.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    odd = [(0, side % 2) for side in (m, k, n)]
    if any(o for _, o in odd):
        a, b = np.pad(a, odd[:2]), np.pad(b, odd[1:])
    mid, inner, wide = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:mid, :inner], a[:mid, inner:], a[mid:, :inner], a[mid:, inner:]
    b11, b12, b21, b22 = b[:inner, :wide], b[:inner, wide:], b[inner:, :wide], b[inner:, wide:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * mid, 2 * wide), np.int64)
    out[:mid, :wide] = p1 + p4 - p5 + p7
    out[:mid, wide:] = p3 + p5
    out[mid:, :wide] = p2 + p4
    out[mid:, wide:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The k best (score, then smaller id) of each anchor so far."""

    def __init__(self, anchors: int, k: int):
        self.k = k
        self.scores = np.full((anchors, k), LOWEST)
        self.ids = np.full((anchors, k), NOBODY)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Columns of `scores`, in ascending `ids`; LOWEST where a column is no candidate. `scores` is used up."""
        who = np.arange(len(scores))
        for _ in range(self.k):
            at = scores[who].argmax(axis=1)  # the first of equals, so the smallest id
            best = scores[who, at]
            live = (best > LOWEST) & (best >= self.scores[who, -1])
            who, at, best = who[live], at[live], best[live]
            if not len(who):
                return
            scores[who, at] = LOWEST
            held = np.column_stack([self.scores[who], best])
            names = np.column_stack([self.ids[who], ids[at]])
            order = np.lexsort((names, -held), axis=1)[:, : self.k]
            self.scores[who] = np.take_along_axis(held, order, 1)
            self.ids[who] = np.take_along_axis(names, order, 1)


def products_by_tile(anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    for start in range(0, len(rows), TILE):
        part = slice(start, start + TILE)
        yield part, strassen(anchors, rows[part].T)


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), width)


def split_cell(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Anchors and rows of a cell, both by id."""
    ordered = table.sort_by("id")
    asks = ordered.column("asks")
    return ordered.filter(asks), ordered.filter(pa.compute.invert(asks))


def positive_cell(k: int) -> Callable[[pa.Table], pa.Table]:
    def found(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        anchors, rows = split_cell(table)
        if not len(anchors) or not len(rows):
            return POSITIVES.empty_table()
        names, ids = anchors.column("id").to_numpy(), rows.column("id").to_numpy()
        own, labels = anchors.column("label").to_numpy(), rows.column("label").to_numpy()
        heaps = Heaps(len(names), k)
        tiles = products_by_tile(matrix(anchors.column("terms"), dim), matrix(rows.column("terms"), dim))
        for part, scores in tiles:
            good = (own[:, None] == labels[part]) & (names[:, None] != ids[part])
            heaps.offer(np.where(good, scores, LOWEST), ids[part])
        real = heaps.ids != NOBODY
        return pa.table(
            [np.repeat(names, real.sum(axis=1)), heaps.ids[real], heaps.scores[real]], schema=POSITIVES
        )

    return found


def negative_cell(k: int, low: int, high: int, per: int) -> Callable[[pa.Table], pa.Table]:
    def found(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        anchors, rows = split_cell(table)
        if not len(anchors) or not len(rows):
            return NEGATIVES.empty_table()
        names, ids = anchors.column("id").to_numpy(), rows.column("id").to_numpy()
        own, labels = anchors.column("label").to_numpy(), rows.column("label").to_numpy()
        positives = anchors.column("positives").to_pylist()
        places = max(map(len, positives))
        windows = []
        for place in range(places):
            who = np.array([i for i, p in enumerate(positives) if len(p) > place])
            score = np.array([positives[i][place]["positive_score"] for i in who], np.int64)
            # per * negative between low * score and high * score: the least and the largest such integer.
            windows.append((who, -((-low * score) // per), (high * score) // per, Heaps(len(who), k)))
        tiles = products_by_tile(matrix(anchors.column("terms"), dim), matrix(rows.column("terms"), dim))
        for part, scores in tiles:
            scores[(own[:, None] == labels[part]) | (names[:, None] == ids[part])] = LOWEST
            for who, least, most, heaps in windows:
                mine = scores[who]
                inside = (mine >= least[:, None]) & (mine <= most[:, None])
                some = inside.any(axis=1)
                if some.any():
                    mine = np.where(inside, mine, LOWEST)
                    heaps.offer(mine, ids[part])
        out = []
        for place, (who, _, _, heaps) in enumerate(windows):
            for i, best, others in zip(who, heaps.scores, heaps.ids, strict=True):
                p = positives[i][place]
                out += [
                    (names[i], place, p["positive_id"], p["positive_score"], other, score)
                    for score, other in zip(best, others, strict=True)
                    if other != NOBODY
                ]
        columns = list(zip(*out, strict=True)) or [[]] * len(NEGATIVES)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, NEGATIVES, strict=True)], schema=NEGATIVES)

    return found


def sweep(
    anchors: DataFrame, rows: DataFrame, parts: int, chunks: int, cell: Callable[[pa.Table], pa.Table], schema: str
) -> DataFrame:
    """`cell` of every chunk of anchors with every part of the rows."""
    part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    sides = [
        rows.select(
            part.alias("part"),
            F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
            F.lit(False).alias("asks"),
            "dim",
            "id",
            "label",
            "terms",
            F.lit(None).cast(anchors.schema["positives"].dataType).alias("positives"),
        ),
        anchors.select(
            F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
            F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"),
            F.lit(True).alias("asks"),
            "dim",
            "id",
            "label",
            "terms",
            "positives",
        ),
    ]
    return sides[0].unionByName(sides[1]).groupBy("part", "chunk", "dim").applyInArrow(cell, schema)


def mine_hard_negatives(
    vectors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int, int] = (80, 100, 100),
    every: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    row_values: int = 2**19,
    anchor_values: int = 2**17,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    A score is the integer inner product of floor(scale * x); higher scores first, ties by smaller id. Anchors are the
    ids divisible by `every`; positives of an anchor are the `positives` best other rows of its label. For each, the
    `negatives` best rows of another label with low * p <= per * n <= high * p, where `window` is (low, high, per).

    Rows without id or label, without a vector or with a null or non-finite component take no part, nor do pairs of
    vectors of different length. Repeated rows are candidates each, but a row with the anchor's id is never its own
    candidate; of several rows with one anchor id, the least (label, terms) asks. An anchor without positives, or a
    window without rows, gives no row. Scores times `per` must fit 64 bits. No rows: no rows.
    """
    vector = F.col(vec_col)
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    taking_part = vectors.filter(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & vector.isNotNull() & sound
    )
    # Written once: both sweeps read it, and `row` deals repeated ids to all parts.
    whole = cut_lineage(
        taking_part.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("id"),
            F.col(label_col).cast("long").alias("label"),
            F.size(vector).alias("dim"),
            F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("terms"),
        )
    )
    asked = whole.filter(F.col("id") % every == 0)
    asked = asked.groupBy("id").agg(F.min(F.struct("label", "dim", "terms")).alias("own")).select("id", "own.*")
    size = whole.agg(
        F.count("*").alias("rows"), F.count_if(F.col("id") % every == 0).alias("anchors"), F.max("dim").alias("dim")
    ).first()
    wide = max(1, size["dim"] or 1)
    parts = max(1, -(-size["rows"] * wide // row_values))
    chunks = max(1, -(-size["anchors"] * wide // anchor_values))

    nothing = F.lit(None).cast("array<struct<positive_id:bigint,positive_score:bigint>>")
    first = sweep(
        asked.withColumn("positives", nothing),
        whole,
        parts,
        chunks,
        positive_cell(positives),
        "anchor_id long, positive_id long, positive_score long",
    )
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    merged = first.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    lists = merged.groupBy(F.col("anchor_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives")
    )
    lists = lists.withColumn(
        "positives", F.transform("positives", lambda p: F.struct(p["positive_id"], p["positive_score"]))
    )
    second = sweep(
        cut_lineage(asked.join(lists, "id")),
        whole,
        parts,
        chunks,
        negative_cell(negatives, *window),
        "anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (
        second.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
