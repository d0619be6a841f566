"""Near-duplicates of weighted word shingles by ProbMinHash, banding and verification.

Every shingle (five words, weighted by its count) sends a Poisson process of arrivals, at its weight's rate, to the
registers of the signature; a register keeps the first to arrive. Processes stop at a horizon by which all
registers are filled, so a document costs about m ln m arrivals beside one per shingle. Two registers agree
with the probability Jaccard similarity of the documents.

Bands of registers make buckets. The documents of shared buckets get a sketch, one bit of each of 1024 registers: pairs
whose sketches agree too little cannot be similar, all others are compared exactly on their texts.

* Buckets of bounded size become distinct sets of documents (near copies meet in many bands, but once as a set). In a
  set, leaders are compared with the members near them, then members with those most alike in another component; this
  joins the copies of a text. What lies near and is still apart forms groups, compared in blocks: two blocks of texts
  meet in a task, and only links that join what was apart leave it.
* A larger bucket has all members compared with one pivot. What is not similar to it stays for the next round, along with
  the members that could still be similar to one of those: the distance is a metric, so a pair whose distances to the
  pivot differ by more than the threshold needs no comparison. A bucket that becomes small goes the way of the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportstar.llm.hashing import mixed, small_batches, word_hashes
from reportstar.sinks.store import cut_lineage

BATCH_BYTES = 4_000_000
BEST_ROUNDS = 2
BLOCK_ROWS = 512
BLOCK_BYTES = 32_000_000
ROUNDING = 1e-9  # of a sum of doubles that is a similarity
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(raw: bytes | np.ndarray, size: int) -> np.ndarray:
    """Hashes of all `size` neighbouring words; of all words if there are fewer; none of no words."""
    buffer = np.frombuffer(raw, np.uint8) if isinstance(raw, bytes) else raw
    words = word_hashes(buffer)[2]
    if not len(words):
        return words
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, np.uint64(width))
    for k in range(width):
        out = out * GOLDEN + words[k : k + len(out)]
    return mixed(out)


def weighted(raw: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    found, counts = np.unique(shingles(raw, size), return_counts=True)
    return found, counts.astype(np.float64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over the common shingles d of 1 / sum over all e of max(x_e / x_d, y_e / y_d)."""
    common, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[1][at_a], b[1][at_b]
    order = np.argsort(x / y, kind="stable")
    ratio, x, y = (x / y)[order], x[order], y[order]
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    below = np.searchsorted(ratio, ratio, "left")
    y_below = np.concatenate([[0.0], np.cumsum(y)])[below]
    x_above = only_a + x.sum() - np.concatenate([[0.0], np.cumsum(x)])[below]
    return float((x / (x_above + ratio * (only_b + y_below))).sum())


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int, m: int) -> np.ndarray:
    """docs x m registers, for the distinct weighted shingles of several documents (each has one at least)."""
    out = np.zeros((docs, m), np.uint64)
    total = np.bincount(owner, weight, docs)
    horizon = (np.log(m) + 4) * m / total
    waiting = np.arange(docs)
    while len(waiting):
        open_doc = np.zeros(docs, bool)
        open_doc[waiting] = True
        mine = open_doc[owner]
        doc, element, rate = owner[mine], shingle[mine], weight[mine]
        at = np.zeros(len(doc))
        cells, times, names, arrival = [], [], [], 0
        while len(doc):
            arrival += 1
            draw = mixed(element + np.uint64(arrival * int(GOLDEN) % (1 << 64)))
            at = at - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / rate
            kept = at <= horizon[doc]
            doc, element, rate, at, draw = doc[kept], element[kept], rate[kept], at[kept], draw[kept]
            register = (mixed(draw) >> np.uint64(32)).astype(np.int64) % m
            cells.append(doc * m + register)
            times.append(at)
            names.append(element)
        cell, time, name = np.concatenate(cells), np.concatenate(times), np.concatenate(names)
        order = np.argsort(-time, kind="stable")  # the earliest is written last
        filled = np.zeros(docs * m, bool)
        filled[cell] = True
        out.reshape(-1)[cell[order]] = name[order]
        waiting = waiting[~filled.reshape(docs, m)[waiting].all(axis=1)]
        horizon[waiting] *= 2
    return out


def band_keys(registers: np.ndarray, rows: int) -> np.ndarray:
    bands = registers.reshape(len(registers), -1, rows)
    key = np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64), bands.shape[:2])
    for k in range(rows):
        key = mixed(key * GOLDEN + bands[:, :, k])
    return key.view(np.int64)


Signed = tuple[pa.RecordBatch, np.ndarray]


def signatures_of(batches: Iterator[pa.RecordBatch], size: int, m: int) -> Iterator[Signed]:
    """Rows and their registers, for rows (of `text` as bytes) that have a word; a few documents at a time, as many as
    fit the arrivals of `m` registers."""
    most = max(1, int(1_500_000 / (m * (np.log(m) + 4))))
    for batch in small_batches(batches, "text", BATCH_BYTES):
        for at in range(0, batch.num_rows, most):
            rows, own, element, weight = [], [], [], []
            for k, text in enumerate(batch["text"].slice(at, most)):
                found, counts = weighted(text.as_py(), size)
                if len(found):
                    own.append(np.full(len(found), len(rows)))
                    rows.append(at + k)
                    element.append(found)
                    weight.append(counts)
            if rows:
                joined = (np.concatenate(x) for x in (own, element, weight))
                yield batch.take(pa.array(rows)), signatures(*joined, len(rows), m)


def signed(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """node, digest, keys (of its bands), for each row of `docs` (node, digest, text as bytes) that has a word."""
    schema = pa.schema([("node", pa.int64()), ("digest", pa.string()), ("keys", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, registers in signatures_of(batches, size, bands * rows):
            yield pa.record_batch([batch["node"], batch["digest"], list(band_keys(registers, rows))], schema=schema)

    return docs.mapInArrow(sign, "node long, digest string, keys array<long>")


def sketched(texts: DataFrame, size: int, bits: int) -> DataFrame:
    """node, sketch: one bit of each of `bits` registers, of `texts` (node, text as bytes)."""
    schema = pa.schema([("node", pa.int64()), ("sketch", pa.binary())])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, registers in signatures_of(batches, size, bits):
            # Each register has its own bit of a shingle: few shingles in many registers are many independent bits.
            own = mixed(registers + np.arange(bits, dtype=np.uint64) * GOLDEN)
            packed = np.packbits((own & np.uint64(1)).astype(np.uint8), axis=1)
            yield pa.record_batch([batch["node"], [row.tobytes() for row in packed]], schema=schema)

    return texts.mapInArrow(sketch, "node long, sketch binary")


def similarities(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """node, pivot, similarity of `pairs` (node, pivot), from `texts` (node, text as bytes)."""
    schema = pa.schema([("node", pa.int64()), ("pivot", pa.int64()), ("similarity", pa.float64())])
    pivots = texts.select(F.col("node").alias("pivot"), F.col("text").alias("pivot_text"))
    both = pairs.join(texts, "node").join(pivots, "pivot")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            out = []
            for pivot, pivot_text, text in zip(batch["pivot"].to_pylist(), batch["pivot_text"], batch["text"], strict=True):
                if pivot != last:  # pairs of one pivot mostly come together
                    last, known = pivot, weighted(pivot_text.as_py(), size)
                out.append(probability_jaccard(weighted(text.as_py(), size), known))
            yield pa.record_batch([batch["node"], batch["pivot"], pa.array(out, pa.float64())], schema=schema)

    return both.select("node", "pivot", "text", "pivot_text").mapInArrow(
        compared, "node long, pivot long, similarity double"
    )


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity by sketches (words of 64 bits in the last axis): a bit agrees with probability (1 + s) / 2."""
    unlike = np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)
    return 1 - 2 * unlike / (64 * a.shape[-1])


Known = tuple[np.ndarray, np.ndarray, np.ndarray]


def undecided(
    sketches: np.ndarray, known: Known, least: float, far: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Some rows at a time, their agreement with all members of a set, and which of these pairs are still to compare:
    near ones of different labels, but for those whose distances to one leader differ by more than `far`. `known`:
    label, leader and exact distance to it, by member."""
    labels, leaders, away = known
    # A pair of different labels has a member outside the most common label.
    kinds, counts = np.unique(labels, return_counts=True)
    others = np.flatnonzero(labels != kinds[counts.argmax()])
    size = max(1, 500_000 // max(1, sketches.size))
    for at in range(0, len(others), size):
        rows = others[at : at + size]
        alike = agreement(sketches[rows, None], sketches[None])
        near = (alike >= least) & (labels[rows, None] != labels[None, :])
        same = leaders[rows, None] == leaders[None, :]
        near &= ~(same & (np.abs(away[rows, None] - away[None, :]) > far + ROUNDING))
        yield rows, alike, near


def leader_pairs(nodes: np.ndarray, sketches: np.ndarray, least: float) -> Iterator[tuple[int, int]]:
    """Leaders of one set (members in order) with the members near them; each member has one leader."""
    waiting = np.arange(len(nodes))
    while len(waiting) > 1:
        leader = waiting[0]
        waiting = waiting[1:]
        near = agreement(sketches[leader], sketches[waiting]) >= least
        yield from ((x, int(nodes[leader])) for x in nodes[waiting[near]].tolist())
        waiting = waiting[~near]


def best_pairs(
    nodes: np.ndarray, sketches: np.ndarray, known: Known, least: float, far: float
) -> Iterator[tuple[int, int]]:
    """Of the undecided pairs of one set, the one most alike for each member outside the most common label."""
    for rows, alike, near in undecided(sketches, known, least, far):
        first = np.where(near, alike, -1).argmax(axis=1)
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            a, b = int(nodes[rows[i]]), int(nodes[first[i]])
            yield max(a, b), min(a, b)


def open_groups(
    nodes: np.ndarray, sketches: np.ndarray, known: Known, least: float, far: float
) -> Iterator[tuple[int, int]]:
    """Members of one set that have an undecided pair, each with the first of those that such pairs connect it with."""
    group = np.arange(len(nodes))
    for rows, _, near in undecided(sketches, known, least, far):
        for row, with_row in zip(rows, near, strict=True):
            met = np.unique(group[np.append(np.flatnonzero(with_row), row)])
            if len(met) > 1:
                group[np.isin(group, met)] = met[0]
    for i in np.flatnonzero(group != np.arange(len(nodes))):
        yield int(nodes[i]), int(nodes[group[i]])


def pairs_of_sets(
    sets: DataFrame, known: DataFrame, chosen: Callable[..., Iterator[tuple[int, int]]], *limits: float
) -> DataFrame:
    """node, pivot as `chosen` from `sets` (members: ids); `known`: node, sketch (and label, leader, away)."""
    schema = pa.schema([("node", pa.int64()), ("pivot", pa.int64())])
    more = [c for c in ("label", "leader", "away") if c in known.columns]
    gathered = (
        sets.select(F.xxhash64("members").alias("set"), F.explode("members").alias("node"))
        .join(known, "node")
        .groupBy("set")
        .agg(F.sort_array(F.collect_list(F.struct("node", "sketch", *more))).alias("of"))
        .select(*(F.col(f"of.{c}").alias(c) for c in ("node", "sketch", *more)))
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for k in range(batch.num_rows):
                nodes = np.array(batch["node"][k].as_py(), np.int64)
                if len(nodes) < 2:
                    continue
                joined = b"".join(batch["sketch"][k].as_py())
                sketches = np.frombuffer(joined, np.uint64).reshape(len(nodes), -1)
                told = [tuple(np.array(batch[c][k].as_py()) for c in more)] if more else []
                found.update(chosen(nodes, sketches, *told, *limits))
            if found:
                yield pa.record_batch([[int(p[i]) for p in found] for i in (0, 1)], schema=schema)

    return gathered.mapInArrow(compared, "node long, pivot long").distinct()


def pivot_rounds(members: DataFrame, sketches: DataFrame, texts: DataFrame, size: int, threshold: float, least: float, most: int):
    """Compare the members (key, node) of buckets larger than `most` with pivots until what is left is smaller. Gives the
    verified pairs, and the members left."""
    far, checked, left = 1 - threshold, None, None
    while True:
        sized = members.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n"))
        rows = cut_lineage(
            members.join(sized.filter(F.col("n") > most).select("key", "pivot"), "key").filter("node <> pivot")
        )
        small = cut_lineage(
            members.join(sized.filter(F.col("n").between(2, most)).select("key"), "key", "left_semi")
        )
        left = small if left is None else left.unionByName(small)
        if rows.isEmpty():
            return checked, left
        pairs = rows.select("node", "pivot").distinct()
        estimated = cut_lineage(estimates(pairs, sketches))
        near = estimated.filter(F.col("estimate") >= least).select("node", "pivot")
        if checked is not None:
            near = near.join(checked, ["node", "pivot"], "left_anti")
        fresh = cut_lineage(similarities(near, texts, size))
        checked = fresh if checked is None else checked.unionByName(fresh)
        # A distance that was only estimated is taken as low as the estimate allows.
        away = F.coalesce(1 - F.col("similarity"), 1 - F.col("estimate") - (threshold - least))
        told = rows.join(
            estimated.join(checked, ["node", "pivot"], "left").select("node", "pivot", "similarity", away.alias("away")),
            ["node", "pivot"],
        ).select("key", "node", "away", (F.coalesce("similarity", F.lit(0.0)) < threshold - ROUNDING).alias("unlike"))
        nearest = told.filter("unlike").groupBy("key").agg(F.min("away").alias("nearest"))
        members = cut_lineage(
            told.join(nearest, "key")
            .filter(F.col("unlike") | (F.col("away") >= F.col("nearest") - far - ROUNDING))
            .select("key", "node")
        )


def estimates(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """node, pivot, estimate: similarity by the sketches."""
    schema = pa.schema([("node", pa.int64()), ("pivot", pa.int64()), ("estimate", pa.float64())])

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (
                    np.frombuffer(b"".join(batch[c].to_pylist()), np.uint64).reshape(batch.num_rows, -1)
                    for c in ("sketch", "other")
                )
                yield pa.record_batch([batch["node"], batch["pivot"], pa.array(agreement(a, b))], schema=schema)

    others = sketches.select(F.col("node").alias("pivot"), F.col("sketch").alias("other"))
    return (
        pairs.join(sketches, "node")
        .join(others, "pivot")
        .select("node", "pivot", "sketch", "other")
        .mapInArrow(told, "node long, pivot long, estimate double")
    )


def links_of_buckets(
    members: DataFrame, sketches: DataFrame, texts: DataFrame, size: int, threshold: float, least: float, most: int
) -> DataFrame:
    """node, pivot of similar pairs: enough of them to connect all that are similar in a bucket of `members` (key, node)."""
    checked, left = pivot_rounds(members, sketches, texts, size, threshold, least, most)
    sets = cut_lineage(
        left.groupBy("key").agg(F.sort_array(F.collect_set("node")).alias("members")).select("members").distinct()
    )

    def verified(pairs: DataFrame) -> DataFrame:
        fresh = pairs if checked is None else pairs.join(checked, ["node", "pivot"], "left_anti")
        done = cut_lineage(similarities(fresh, texts, size))
        return done if checked is None else checked.unionByName(done)

    def similar() -> DataFrame:
        return checked.filter(F.col("similarity") >= threshold - ROUNDING).select("node", "pivot")

    far = 1 - threshold
    checked = verified(pairs_of_sets(sets, sketches, leader_pairs, least))

    def known() -> DataFrame:
        leaders = checked.groupBy("node").agg(
            F.min(F.struct(F.col("pivot"), (1 - F.col("similarity")).alias("away"))).alias("led")
        )
        return (
            sketches.join(components(similar()), "node", "left")
            .join(leaders, "node", "left")
            .select(
                "node",
                "sketch",
                F.coalesce("label", "node").alias("label"),
                F.coalesce("led.pivot", "node").alias("leader"),
                F.coalesce("led.away", F.lit(0.0)).alias("away"),
            )
        )

    # First what is most alike, which leaves few components and so few pairs between them.
    for _ in range(BEST_ROUNDS):
        checked = verified(pairs_of_sets(sets, known(), best_pairs, least, far))
    told = cut_lineage(known())
    groups = components(pairs_of_sets(sets, told, open_groups, least, far))
    return similar().unionByName(links_of_groups(groups, told, texts, size, threshold, least))


def links_of_groups(
    groups: DataFrame, known: DataFrame, texts: DataFrame, size: int, threshold: float, least: float
) -> DataFrame:
    """node, pivot of similar pairs of different labels: enough of them to connect the labels in each of `groups` (node,
    label). A group is dealt into blocks; a task compares two blocks on their texts, so that pairs leave it as links only
    and a text travels once per block of its group."""
    schema = pa.schema([("node", pa.int64()), ("pivot", pa.int64())])
    held = cut_lineage(
        groups.select("node", F.col("label").alias("group")).join(known, "node").join(texts, "node")
    )
    blocks = held.groupBy("group").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum(F.octet_length("text")) / BLOCK_BYTES)).alias("blocks")
    )
    # Blocks dealt by hash are even without an order of the group.
    dealt = held.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    meeting = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.struct(F.least("block", other).alias("i"), F.greatest("block", other).alias("j")),
    )

    def compared(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        nodes, labels, leaders, away, block = (
            table[c].to_numpy() for c in ("node", "label", "leader", "away", "block")
        )
        sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(nodes), -1)
        across = block.min() < block.max()
        shingled: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        joined: dict[int, int] = {}

        def root(label: int) -> int:
            while label in joined:
                label = joined[label]
            return label

        def of(k: int) -> tuple[np.ndarray, np.ndarray]:
            if k not in shingled:
                shingled[k] = weighted(table["text"][k].as_py(), size)
            return shingled[k]

        links = []
        for rows, alike, near in undecided(sketches, (labels, leaders, away), least, 1 - threshold):
            if across:  # pairs within a block are compared where it meets itself
                near &= block[rows, None] != block[None, :]
            at, other = np.nonzero(near)
            for k in np.argsort(-alike[at, other], kind="stable"):  # the most alike may join labels first
                a, b = int(rows[at[k]]), int(other[k])
                one, two = root(int(labels[a])), root(int(labels[b]))
                if one != two and probability_jaccard(of(a), of(b)) >= threshold - ROUNDING:
                    joined[max(one, two)] = min(one, two)
                    links.append((max(nodes[a], nodes[b]), min(nodes[a], nodes[b])))
        return pa.table([[int(link[i]) for link in links] for i in (0, 1)], schema=schema)

    return (
        dealt.select("*", F.explode(meeting).alias("pair"))
        .select("node", "sketch", "label", "leader", "away", "text", "block", "group", "pair.i", "pair.j")
        .groupBy("group", "i", "j")
        .applyInArrow(compared, "node long, pivot long")
    )


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that links (node, pivot) connect it with."""
    edges = cut_lineage(
        links.unionByName(links.select(F.col("pivot").alias("node"), F.col("node").alias("pivot"))).distinct()
    )
    labels = cut_lineage(
        edges.groupBy("node").agg(F.least(F.min("pivot"), F.first("node")).alias("label"))
    )
    while True:
        seen = edges.join(
            labels.select(F.col("node").alias("pivot"), F.col("label").alias("heard")), "pivot"
        )
        heard = seen.groupBy("node").agg(F.min("heard").alias("heard"))
        lower = labels.join(heard, "node").select(
            "node", "label", F.least("label", "heard").alias("lower")
        )
        jump = labels.select(F.col("node").alias("lower"), F.col("label").alias("further"))
        after = cut_lineage(
            lower.join(jump, "lower").select("node", "label", F.least("lower", "further").alias("lower"))
        )
        settled = after.filter("lower < label").isEmpty()
        labels = after.select("node", F.col("lower").alias("label"))
        if settled:
            return labels


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    threshold: float = 0.8,
    bands: int = 32,
    rows: int = 4,
    sketch_bits: int = 1024,
    margin: float = 0.1,
    largest_set: int = 20_000,
) -> DataFrame:
    """One row per row of `docs`: id, class_id (the smallest id of its class), n_copies (rows of the same text).

    A class is connected by links of similarity `threshold` or more. With 32 bands of 4 a pair at 0.8 is missed
    with probability 5e-8; its similarity by sketches of 1024 bits is below `threshold - margin` (5.3 standard
    deviations) with 6e-8. Equal texts are one class, null and empty texts included (a null text is empty); texts of blanks only
    have no shingle and are like their equals alone. A text of fewer than `shingle` words is one shingle. Rows of
    one id are one document: if their texts differ, they share a class and the first by digest is compared. Texts
    that only rows with a null id hold form classes of equal texts with a null class_id. No rows: no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.sha2(text, 256).alias("digest"))
    copies = cut_lineage(named.groupBy("digest").agg(F.min("id").alias("node"), F.count("*").alias("n_copies")))
    speakers = (
        copies.filter("node IS NOT NULL").groupBy("node").agg(F.min("digest").alias("digest"))
    )
    bytes_of = docs.select(
        F.col(id_col).cast("long").alias("node"), F.sha2(text, 256).alias("digest"), text.cast("binary").alias("text")
    ).filter("node IS NOT NULL")
    # Only the documents that speak for their text are compared; repeated rows have the same signature.
    signs = cut_lineage(signed(bytes_of.select("node", "digest", "text"), shingle, bands, rows))
    signs = cut_lineage(signs.join(speakers, ["node", "digest"], "left_semi").drop("digest").distinct())
    members = signs.select(F.explode("keys").alias("key"), "node")
    shared = members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = cut_lineage(members.join(shared, "key", "left_semi"))
    needed = cut_lineage(members.select("node").distinct())
    texts = cut_lineage(
        bytes_of.join(needed.join(speakers, "node"), ["node", "digest"], "left_semi")
        .groupBy("node", "digest")
        .agg(F.first("text").alias("text"))
        .drop("digest")
    )
    sketches = cut_lineage(sketched(texts, shingle, sketch_bits))
    labels = components(
        links_of_buckets(members, sketches, texts, shingle, threshold, threshold - margin, largest_set)
    )
    classes = copies.join(labels, "node", "left").select(
        "digest", F.coalesce("label", "node").alias("class_id"), "n_copies"
    )
    return named.join(classes, "digest").select("id", "class_id", "n_copies")
