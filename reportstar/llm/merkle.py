"""Merkle manifest of a dataset, on levels kept as hex strings.

Leaves are placed in order within their group. An aligned block of them keeps each of its levels as one hex string:
fixed-width substrings of a level are hashed to the level above, and the siblings of a node are the substrings that
flank it within its run. The tops of the blocks are the nodes of the next tier, until a group has one top, its
subroot; the subroots form the tree of the root in the same way. Proofs come back down: a block hands the siblings
above it to its members, so a node is only ever joined with the block that holds it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportstar.llm.columns import bound
from reportstar.sinks.store import cut_lineage

HEX = 64  # digits of a digest
# monotonically_increasing_id() puts the partition number above these bits.
POSITION_BITS = 33
NO_SIBLINGS = "cast(array() AS array<string>)"


def spelled(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, `:`, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[spelled(v) for v in values]), 256)


def height_of(rows: Column, fanout: int) -> Column:
    """Levels above `rows` leaves: the digits of the last leaf's number."""
    return F.when(rows <= 1, 0).otherwise(F.length(F.conv((rows - 1).cast("string"), 10, fanout)))


def raised(level: Column, fanout: int) -> Column:
    """The level above: each run of `fanout` digests is hashed, the last run may be shorter."""
    width = fanout * HEX

    def parents(whole: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.length(whole) / width).cast("int") - 1)
        return F.array_join(
            F.transform(runs, lambda i: F.sha2(F.substring(whole, i * width + 1, F.lit(width)), 256)), ""
        )

    return bound(level, parents)


def placed(nodes: DataFrame, keys: Sequence[str], fanout: int) -> DataFrame:
    """`nodes` with `at`, their place from 0 within `grp` in the order of `keys`, and the `height` of the group.

    Ranges are sorted where they are; only a row count per range and group is added up across them.
    """
    ranged = cut_lineage(
        nodes.repartitionByRange("grp", *keys)
        .sortWithinPartitions("grp", *keys)
        .withColumn("_seq", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_seq", POSITION_BITS))
    spans = ranged.groupBy("_part", "grp").agg(F.min("_seq").alias("_first"), F.count("*").alias("_rows"))
    group = Window.partitionBy("grp")
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = spans.select(
        "_part",
        "grp",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        height_of(F.sum("_rows").over(group), fanout).alias("height"),
    )
    return ranged.join(shifts, ["_part", "grp"]).select(
        *nodes.columns, (F.col("_seq") + F.col("_shift")).alias("at"), "height"
    )


def ascend(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """The tiers over `nodes` (grp, at, height, digest, carried), written. A tier has a row for each block: grp, block,
    height (levels that its nodes have above them), members, level_0 ... of as many as are hashed, top."""
    span = fanout**levels
    tiers = []
    left = nodes.agg(F.max("height")).first()[0] or 0
    while True:
        tier = nodes.groupBy("grp", F.floor(F.col("at") / span).alias("block"), "height").agg(
            F.sort_array(F.collect_list(F.struct("at", "digest", "carried"))).alias("members")
        )
        tier = tier.withColumn("level_0", F.array_join(F.transform("members", lambda m: m["digest"]), ""))
        for k in range(levels):
            above = F.when(F.col("height") > k, raised(F.col(f"level_{k}"), fanout))
            tier = tier.withColumn(f"level_{k + 1}", above)
        top = F.coalesce(*[F.col(f"level_{k}") for k in range(levels, -1, -1)])
        tiers.append(cut_lineage(tier.withColumn("top", top).drop(f"level_{levels}")))
        if left <= levels:
            return tiers
        left -= levels
        nodes = tiers[-1].filter(F.col("height") > levels).select(
            "grp",
            F.col("block").alias("at"),
            (F.col("height") - levels).alias("height"),
            F.col("top").alias("digest"),
            F.lit(None).cast("string").alias("carried"),
        )


def descend(tiers: list[DataFrame], fanout: int, levels: int, above: DataFrame | None = None) -> DataFrame:
    """grp, at, digest, carried, lefts, rights, subroot, root of the nodes below the first tier. `above` has lefts,
    rights and root of each group's subroot (none: the subroot is the root). lefts and rights: what stands before and
    after the node in its run, level by level upwards."""
    heads = None
    for tier in reversed(tiers):
        tops = tier.filter(F.col("height") <= levels)
        if above is None:
            tops = tops.select(
                "grp",
                F.lit(0).cast("long").alias("block"),
                F.expr(NO_SIBLINGS).alias("up_lefts"),
                F.expr(NO_SIBLINGS).alias("up_rights"),
                F.col("top").alias("subroot"),
                F.col("top").alias("root"),
            )
        else:
            tops = tops.select("grp", "block", F.col("top").alias("subroot")).join(above, "grp")
            tops = tops.select("grp", "block", "up_lefts", "up_rights", "subroot", "root")
        heads = tops if heads is None else tops.unionByName(heads)
        inner = tier.join(heads, ["grp", "block"]).select("*", F.explode("members").alias("node"))
        lefts, rights = [], []
        for k in range(levels):
            place = F.floor((F.col("node.at") - F.col("block") * fanout**levels) / fanout**k).cast("int")
            nth = place % fanout
            level = F.col(f"level_{k}")
            lefts.append(F.substring(level, (place - nth) * HEX + 1, nth * HEX))
            rights.append(F.substring(level, (place + 1) * HEX + 1, (fanout - 1 - nth) * HEX))
        hashed = F.least(F.col("height"), F.lit(levels))
        found = inner.select(
            "grp",
            F.col("node.at").alias("at"),
            F.col("node.digest").alias("digest"),
            F.col("node.carried").alias("carried"),
            F.concat(F.slice(F.array(*lefts), 1, hashed), F.col("up_lefts")).alias("lefts"),
            F.concat(F.slice(F.array(*rights), 1, hashed), F.col("up_rights")).alias("rights"),
            "subroot",
            "root",
        )
        heads = found.select(
            "grp",
            F.col("at").alias("block"),
            F.col("lefts").alias("up_lefts"),
            F.col("rights").alias("up_rights"),
            "subroot",
            "root",
        )
    return found


def fold(leaf: Column, lefts: Column, rights: Column) -> Column:
    """The root that `leaf` and the siblings of its proof lead to."""
    steps = F.zip_with(lefts, rights, lambda a, b: F.struct(a.alias("before"), b.alias("after")))
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def proof_text(lefts: Column, rights: Column) -> Column:
    """All siblings of a proof, level by level, left to right."""
    return F.array_join(F.zip_with(lefts, rights, lambda a, b: F.concat(a, b)), "")


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "lang",
    id_col: str = "doc_id",
    carried: Sequence[Column] = (),
    fanout: int = 8,
    levels: int = 2,
) -> DataFrame:
    """One row per row of `docs`: id, grp, leaf, subroot, root, and its proof `lefts`, `rights`; `carried` as a struct.

    A leaf is the sha256 of the spelled `fields`, in hex. Within a group leaves ascend by id (no id first), then by
    digest: rows equal in all fields are interchangeable. Every `fanout` neighbours become one node, also a last run of
    one, until one node remains; a lone leaf is the subroot itself. Groups are ordered bytewise, no group first; an
    empty name is a group of its own. `carried` must be of types that can be ordered. No rows: no rows.
    """
    name = F.col(group_col).cast("string")
    leaves = docs.select(
        F.when(name.isNull(), "-").otherwise(F.concat(F.lit("="), name)).alias("grp"),  # - sorts before =
        F.col(id_col).cast("long").alias("id"),
        leaf_digest([F.col(f) for f in fields]).alias("digest"),
        F.struct(F.lit(0).alias("_"), *carried).alias("more"),
    )
    nodes = placed(leaves, ["id", "digest"], fanout).select(
        "grp", "at", "height", "digest", F.struct("id", "more").alias("carried")
    )
    tiers = ascend(nodes, fanout, levels)
    subroots = [t.filter(F.col("height") <= levels).select("grp", F.col("top").alias("digest")) for t in tiers]
    tops = subroots[0]
    for more in subroots[1:]:
        tops = tops.unionByName(more)
    tops = tops.select(F.lit("").alias("grp"), F.col("grp").alias("carried"), "digest")
    crown = ascend(placed(tops, ["carried"], fanout), fanout, levels)
    above = descend(crown, fanout, levels).select(
        F.col("carried").alias("grp"),
        F.col("lefts").alias("up_lefts"),
        F.col("rights").alias("up_rights"),
        "root",
    )
    return descend(tiers, fanout, levels, cut_lineage(above)).select(
        F.col("carried.id").alias("id"),
        F.expr("if(grp = '-', NULL, substring(grp, 2))").alias("grp"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "lefts",
        "rights",
        F.col("carried.more").alias("carried"),
    )
