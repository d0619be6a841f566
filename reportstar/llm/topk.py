"""Exact top-k by inner product, with blocks pruned by their bounds.

Vectors are cut into blocks of neighbouring ids. A block keeps its forward index (the rows themselves) and, per
term (dimension), the largest and smallest value; summed over the terms of a query these bound every score in
the block from above. For each query the blocks are scored in falling order of the bound until the bound
falls below the k-th score so far.

The work is laid out as a grid of cells: a stretch of blocks against a bounded chunk of queries, and a merge
of at most k rows per cell and query. The queries are a stated set (every `every`-th id), so a cell is a block
of work of fixed size, not a join of the table with itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EXACT = 2.0**53
LOWEST, NOBODY = -(2**62), 2**63 - 1
CELL = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """id, terms: floor(scale * x) of whole finite vectors; others are left out."""
    sound = F.forall(
        F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    terms = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.filter(F.col(vec_col).isNotNull() & sound & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), terms.alias("terms"), F.size(vec_col).alias("dim")
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, in floating point only where that is exact."""
    most = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0))
    if most * max(1, a.shape[1]) < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def best_of_cell(queries, query_ids, rows, ids, k: int, block: int) -> tuple[np.ndarray, ...]:
    """The k best (score, then smaller id) of `rows` for each query, never a row with the query's id."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    starts = np.arange(0, len(ids), block)
    high = np.maximum.reduceat(rows, starts, axis=0)
    low = np.minimum.reduceat(rows, starts, axis=0)
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
    bounds = products(positive, high) + products(negative, low)
    turn = np.argsort(-bounds, axis=1, kind="stable")
    scores = np.full((len(queries), k), LOWEST)
    found = np.full((len(queries), k), NOBODY)
    everyone = np.arange(len(queries))
    for step in range(len(starts)):
        at = turn[:, step]
        live = np.flatnonzero(bounds[everyone, at] >= scores[:, -1])
        if not len(live):
            break
        for b in np.unique(at[live]):
            who = live[at[live] == b]
            part = slice(starts[b], starts[b] + block)
            own = ids[part][None, :] == query_ids[who][:, None]
            fresh = np.where(own, LOWEST, products(queries[who], rows[part]))
            better = fresh.max(axis=1) >= scores[who, -1]
            who, fresh, own = who[better], fresh[better], own[better]
            names = np.where(own, NOBODY, ids[part][None, :])
            taken = np.concatenate([scores[who], fresh], axis=1)
            names = np.concatenate([found[who], names], axis=1)
            best = np.lexsort((names, -taken), axis=1)[:, :k]
            scores[who] = np.take_along_axis(taken, best, 1)
            found[who] = np.take_along_axis(names, best, 1)
    real = found != NOBODY
    return np.repeat(query_ids, real.sum(axis=1)), found[real], scores[real]


def exact_top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block: int = 256,
    rows_per_cell: int = 8192,
    queries_per_cell: int = 1024,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of highest integer inner product for each query.

    Queries are the rows whose id is divisible by `every`; a row with the query's id is its own and no
    candidate. Ties go to the smaller id. Repeated rows each count as a candidate; repeated query ids share
    one ranking. Vectors that are null or hold null or non-finite components take no part, nor do pairs of
    different length. Fewer than k candidates: all of them. Products must fit 64 bits. No rows: no rows.
    """
    whole = quantised(vectors, id_col, vec_col, scale)
    counts = whole.agg(
        F.count("*").alias("rows"), F.count_if(F.col("id") % every == 0).alias("queries")
    ).first()
    parts = max(1, -(-counts["rows"] // rows_per_cell))
    chunks = max(1, -(-counts["queries"] // queries_per_cell))
    lows = F.floor(F.col("id") / block)  # neighbours stay in one block, blocks are dealt evenly
    rows = whole.select(
        F.pmod(F.xxhash64(lows), F.lit(parts)).alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
        "dim",
        "id",
        "terms",
        F.lit(False).alias("asks"),
    )
    asked = whole.filter(F.col("id") % every == 0).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"),
        F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"),
        "dim",
        "id",
        "terms",
        F.lit(True).alias("asks"),
    )

    def cell(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        ids = table.column("id").to_numpy()
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        terms = table.column("terms").combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
        if not asks.any() or asks.all():
            return CELL.empty_table()
        q, v, s = best_of_cell(terms[asks], ids[asks], terms[~asks], ids[~asks], k, block)
        return pa.table([q, v, s], schema=CELL)

    cells = (
        rows.unionByName(asked)
        .groupBy("part", "chunk", "dim")
        .applyInArrow(cell, "query_id long, vec_id long, score long")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        cells.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
