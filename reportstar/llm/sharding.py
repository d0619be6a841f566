"""Sharding by sampled splitters.

Records are ordered by (md5 of the text, id): equal texts lie together, and a group of copies that holds a
third of all rows can still be cut between two ids. A size-weighted sample of keys gives quantile boundaries;
ranges that turn out overfull are sampled again and subdivided. Sums per range then place every record at its
exact byte position in the whole order, and a shard is an equal stretch of bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportstar.sinks.store import cut_lineage

OVERHEAD = 16
LOWEST_LONG = -(2**63)
UNIT = 2.0**53


def sort_key(text: Column, identifier: Column) -> Column:
    """Text digest, then the id in an order-preserving spelling; no id sorts first."""
    spelled = F.lpad(F.hex(identifier.cast("long").bitwiseXOR(F.lit(LOWEST_LONG))), 16, "0")
    return F.concat(F.md5(text), F.coalesce(spelled, F.lit("")))


def range_of(key: Column, splitters: Sequence[str]) -> Column:
    """How many splitters are at or below the key, by binary search."""
    if not splitters:
        return F.lit(0)
    table = F.lit(list(splitters))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(splitters)).alias("hi"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        below = F.get(table, middle) <= key
        return F.struct(
            F.when((state["lo"] < state["hi"]) & below, middle + 1).otherwise(state["lo"]).alias("lo"),
            F.when((state["lo"] < state["hi"]) & ~below, middle).otherwise(state["hi"]).alias("hi"),
        )

    steps = F.sequence(F.lit(1), F.lit(len(splitters).bit_length()))
    return F.aggregate(steps, start, halve, lambda state: state["lo"])


def sample_splitters(
    keyed: DataFrame, total: float, pieces: int, draws_per_piece: int, seed: int
) -> list[str]:
    """Boundaries that cut `keyed` (key, weight) into about `pieces` equal parts by weight.

    A record is drawn with probability draws * weight / total by a hash of its key, so a recomputed task
    draws the same records; one heavier than a draw counts with its weight.
    """
    draws = pieces * draws_per_piece
    share = F.col("weight") * F.lit(draws / total)
    chance = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(2**53)) / F.lit(UNIT)
    drawn = keyed.filter(chance < share).select("key", F.greatest(share, F.lit(1.0)).alias("mass"))
    upto = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everywhere = Window.partitionBy()
    part = F.floor(F.sum("mass").over(upto) * pieces / F.sum("mass").over(everywhere))
    firsts = drawn.select("key", part.alias("part")).groupBy("part").agg(F.min("key").alias("key"))
    return sorted({row["key"] for row in firsts.filter("part > 0").collect()})


def split_ranges(
    keyed: DataFrame,
    rows: int,
    pieces: int,
    draws_per_piece: int = 32,
    fullest: float = 2.0,
    rounds: int = 4,
) -> list[str]:
    """Splitters for `keyed` (key, size): no range holds over `fullest` times its share, unless one key does.

    A record's weight is half its share of the bytes and half its share of the rows, so that a range is bounded
    in both. At most pieces * draws_per_piece keys are drawn a round.
    """
    total = keyed.agg(F.sum("size")).first()[0]
    weight = F.col("size") / F.lit(2.0 * total) + F.lit(0.5 / rows)
    weighed = keyed.select("key", weight.alias("weight"))
    splitters = sample_splitters(weighed, 1.0, pieces, draws_per_piece, 0)
    for attempt in range(1, rounds):
        ranged = weighed.withColumn("range", range_of(F.col("key"), splitters))
        full = (
            ranged.groupBy("range")
            .agg(F.sum("weight").alias("weight"), F.min("key").alias("low"), F.max("key").alias("high"))
            .filter((F.col("weight") > fullest / pieces) & (F.col("low") < F.col("high")))
            .collect()
        )
        if not full:
            break
        inside = ranged.filter(F.col("range").isin([r["range"] for r in full]))
        mass = sum(r["weight"] for r in full)
        more = sample_splitters(inside, mass, int(2 * mass * pieces) + 2, draws_per_piece, attempt)
        splitters = sorted({*splitters, *more})
    return splitters


def shard_documents(
    docs: DataFrame,
    shards: int,
    payload: Sequence[Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_range: int = 250_000,
) -> DataFrame:
    """Each row of `docs` as `record` (its columns, or those of `payload`), with `size`, `shard` and `slot`.

    size: UTF-8 bytes of the text plus 16. Shard k holds the records that begin in the k-th of `shards` equal
    stretches of all bytes, so two shards differ by less than their largest records. slot counts from 0 without
    gaps in key order.

    Null texts are empty texts. A null id sorts before all ids. Rows equal in text and id are interchangeable
    and all kept. No rows: no rows. A text longer than a stretch leaves the shards it covers empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    record = F.struct(*payload) if payload is not None else F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    keyed = docs.select(
        sort_key(text, F.col(id_col)).alias("key"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        record.alias("record"),
    )
    narrow = cut_lineage(keyed.select("key", "size"))
    rows = narrow.count()
    if not rows:
        return keyed.select(
            "record", "size", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")
        )
    pieces = max(4 * shards, -(-rows // rows_per_range))
    splitters = split_ranges(narrow, rows, pieces)
    sums = {
        r["range"]: (r["bytes"], r["rows"])
        for r in narrow.groupBy(range_of(F.col("key"), splitters).alias("range"))
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .collect()
    }
    bytes_before, rows_before, at = [], [], (0, 0)
    for k in range(len(splitters) + 1):
        bytes_before.append(at[0])
        rows_before.append(at[1])
        more = sums.get(k, (0, 0))
        at = (at[0] + more[0], at[1] + more[1])
    total = at[0]

    def placed(frame: DataFrame) -> DataFrame:
        ranged = frame.withColumn("range", range_of(F.col("key"), splitters))
        inside = Window.partitionBy("range").orderBy("key")
        before = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return ranged.withColumns(
            {
                "before": F.get(F.lit(bytes_before), F.col("range")) + before - F.col("size"),
                "place": F.get(F.lit(rows_before), F.col("range")) + F.row_number().over(inside) - 1,
            }
        ).withColumn("shard", F.expr(f"int((before * {shards}) div {total})"))

    first = {
        r["shard"]: r["place"]
        for r in placed(narrow).groupBy("shard").agg(F.min("place").alias("place")).collect()
    }
    starts = F.lit([first.get(k, 0) for k in range(shards)])
    return placed(keyed).select(
        "record",
        "size",
        "shard",
        (F.col("place") - F.get(starts, F.col("shard"))).cast("long").alias("slot"),
    )
