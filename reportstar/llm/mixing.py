"""Mixing sources to target weights by temperature.

The token share of each source is raised to an exponent, which is bisected until the mix meets a target entropy
or a limit on repetition; normalised, these are the target weights. Each source then gives its part of the token
budget as whole permutations of its blocks and the beginning of one more, cut inside a block.

Decisions are a few values per source (whole epochs, and the point where the last permutation is cut), so the
documents themselves are not shuffled: they meet a small table of sources.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportstar.sinks.store import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_ROWS = 10_000
STEPS = 32
ROUNDS = 9


def word_tokens(text: Column) -> Column:
    """Words, and one for the end of the document."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)) + 1).cast("long")


def flattest(meets: Callable[[list[float]], list[bool]], low: float = 0.0, high: float = 1.0) -> float:
    """Smallest exponent in [low, high] that meets a condition which holds from some exponent on, by
    sections: each round asks for many exponents at once. `high` if none below does."""
    if meets([low])[0]:
        return low
    for _ in range(ROUNDS):
        asked = [low + (high - low) * k / STEPS for k in range(1, STEPS)]
        first = next((k for k, ok in enumerate(meets(asked)) if ok), len(asked))
        low, high = ([low, *asked][first], [*asked, high][first])
    return high


def bisect_exponent(
    shares: DataFrame, repeat_limit: float | None, target_entropy: float | None
) -> float:
    """Exponent for `shares` (share of each source).

    repeat_limit: the flattest mix in which no source is seen more often than this, times the largest one.
    target_entropy (nats): the steepest mix whose entropy is at least this, or the uniform one.
    """

    def asked(exponents: list[float], value: Callable[[float], Column]) -> list:
        return list(shares.agg(*[value(a).alias(f"v{i}") for i, a in enumerate(exponents)]).first())

    if target_entropy is not None:

        def entropy(a: float) -> Column:
            raised = F.pow("share", F.lit(a))
            return F.log(F.sum(raised)) - F.lit(a) * F.sum(raised * F.log("share")) / F.sum(raised)

        # Entropy falls with the exponent: look for the smallest one that is too low.
        return flattest(lambda xs: [v < target_entropy for v in asked(xs, entropy)])

    def repeats(a: float) -> Column:
        return F.pow(F.max("share") / F.min("share"), F.lit(1 - a))

    return flattest(lambda xs: [v <= repeat_limit for v in asked(xs, repeats)])


def mix_sources(
    docs: DataFrame,
    repeat_limit: float | None = 2.0,
    target_entropy: float | None = None,
    budget: int | None = None,
    seed: int = 0,
    block_tokens: int = 1 << 22,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    tokens: Callable[[Column], Column] = word_tokens,
) -> DataFrame:
    """Rows of the mix: `record` (all columns of `docs`), mix_source, tokens, target_tokens, epoch, order_key.

    budget: tokens of the whole mix; by default the smallest that uses every document at least once. A source
    is read in its order of (epoch, order_key): blocks in a new random order each epoch, documents in random order
    inside. Its tokens miss the target by less than one document.

    A null source is the source ''. Null and empty texts count one token (their end), so no source is empty.
    Null ids hash alike and stay together, as do repeated rows: all of them are taken or none in an epoch. One
    source only: its weight is 1. No rows: no rows.
    """
    source = F.coalesce(F.col(source_col), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    narrow = cut_lineage(
        docs.select(source.alias("mix_source"), name.alias("name"), tokens(F.col(text_col)).alias("tokens"))
    )
    totals = cut_lineage(narrow.groupBy("mix_source").agg(F.sum("tokens").alias("held")))
    known = totals.agg(F.count("*").alias("sources"), F.sum("held").alias("all"), F.max("held").alias("most")).first()
    if not known["sources"]:
        return _shown(docs, F.lit(""), F.lit(0), F.lit(0), F.lit(0), F.lit("")).limit(0)
    shares = totals.select((F.col("held") / F.lit(known["all"])).alias("share"))
    exponent = bisect_exponent(shares, repeat_limit, target_entropy)
    raised = F.pow(F.col("held") / F.lit(float(known["all"])), F.lit(exponent))
    norm = totals.agg(F.sum(raised)).first()[0]
    largest = known["most"] / known["all"]
    whole = budget if budget is not None else known["all"] * norm * largest ** (1 - exponent)
    small = known["sources"] <= BROADCAST_ROWS
    sized = (lambda t: F.broadcast(t)) if small else (lambda t: t)

    target = F.round(raised / F.lit(norm) * F.lit(whole)).cast("long")
    plan = totals.select(
        "mix_source",
        target.alias("target_tokens"),
        F.floor(target / F.col("held")).cast("long").alias("epochs"),
        (target % F.col("held")).alias("rest"),
        F.ceil(F.col("held") / F.lit(block_tokens)).cast("long").alias("blocks"),
    )

    def code(*parts: Column) -> Column:
        return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, 16)

    def block(of: Column) -> Column:
        # The block of a document is the same in every epoch.
        return F.conv(F.substring(F.md5(of), 1, 12), 16, 10).cast("long") % F.col("blocks")

    def orders(epoch: Column, of: Column) -> tuple[Column, Column]:
        return code(epoch, F.lit("b"), block(of)), code(epoch, F.lit("d"), of)

    # The cut of the last epoch: first the block, from the blocks' sums, then the document inside it.
    by_block, by_doc = orders(F.col("epochs"), F.col("name"))
    unfinished = plan.filter("rest > 0")
    coded = narrow.join(sized(unfinished), "mix_source").select(
        "mix_source", "rest", by_block.alias("by_block"), by_doc.alias("by_doc"), "tokens"
    )
    running = Window.partitionBy("mix_source").orderBy("by_block")
    sums = coded.groupBy("mix_source", "rest", "by_block").agg(F.sum("tokens").alias("tokens"))
    cut_blocks = cut_lineage(
        sums.withColumn("before", F.sum("tokens").over(running) - F.col("tokens"))
        .filter("before < rest")
        .groupBy("mix_source")
        .agg(F.max(F.struct("by_block", (F.col("rest") - F.col("before")).alias("left"))).alias("cut"))
        .select("mix_source", F.col("cut.by_block").alias("by_block"), F.col("cut.left").alias("left"))
    )
    inside = (
        coded.join(sized(cut_blocks), ["mix_source", "by_block"])
        .groupBy("mix_source", "left", "by_block", "by_doc")
        .agg(F.sum("tokens").alias("tokens"))
    )
    in_block = Window.partitionBy("mix_source").orderBy("by_doc")
    cuts = (
        inside.withColumn("before", F.sum("tokens").over(in_block) - F.col("tokens"))
        .filter("before < left")
        .groupBy("mix_source")
        .agg(F.max(F.concat("by_block", "by_doc")).alias("last"))
    )
    plan = cut_lineage(plan.join(cuts, "mix_source", "left"))

    labelled = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record"),
        source.alias("mix_source"),
        name.alias("name"),
        tokens(F.col(text_col)).alias("tokens"),
    ).join(sized(plan), "mix_source")
    again = F.concat(*orders(F.col("epochs"), F.col("name"))) <= F.col("last")
    copies = F.col("epochs") + F.when(again, 1).otherwise(0)
    seen = labelled.withColumn(
        "epoch", F.explode(F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1)))
    )
    order = F.concat(*orders(F.col("epoch"), F.col("name")))
    return seen.select("record", "mix_source", "tokens", "target_tokens", "epoch", order.alias("order_key"))


def _shown(docs: DataFrame, *columns: Column) -> DataFrame:
    kinds = ("mix_source", "string"), ("tokens", "long"), ("target_tokens", "long"), ("epoch", "long"), ("order_key", "string")
    record = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record")
    return docs.select(record, *[c.cast(k).alias(n) for c, (n, k) in zip(columns, kinds, strict=True)])
