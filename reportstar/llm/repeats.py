"""Repeated windows across documents, routed to where they can be compared.

A window is `window` neighbouring units (bytes or words) of one document. Its anchor is the leftmost smallest hash
among the runs of `gram` units inside it, so equal windows have equal anchors wherever they occur.

1. Every batch of documents sends its anchors to hash buckets, one entry per anchor and batch. An anchor seen once
   in a batch and nowhere else can belong to no repeated window. One seen twice in a batch is known to repeat at once.
2. Documents meet their repeated anchors and send the context of each, the stretch of all windows it anchors, to
   the anchor's bucket. Equal contexts of a batch of documents travel once, with their smallest document.
3. In a bucket, which holds every occurrence of its windows, an index decides which windows a smaller document has
   too. This is the caller's part.
4. Documents meet their covered windows again and lose those units.

Texts travel compressed; entries and contexts travel as packed arrays. Buckets and groups of documents are as many
as the bytes need, so their size does not grow with the input.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportstar.llm.hashing import BASE, mixed, small_batches, word_hashes, word_spans
from reportstar.sinks.store import cut_lineage

BATCH_BYTES = 4_000_000
HASH_BITS = np.uint64(40)
ROW = pa.schema([("key", pa.int64()), ("blob", pa.binary())])
ROW_DDL = "key long, blob binary"

# What a bucket gets: contexts, the id each comes from, how many starts it has there, and the starts of all with the
# codes of their rows' texts.
Contexts = tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]
# What it gives: id, code, first window, number of windows.
Spans = list[tuple[int, int, int, int]] | np.ndarray


@dataclass(frozen=True)
class Units:
    """Bytes, or words (runs of bytes that are not ASCII white space)."""

    window: int
    gram: int
    words: bool

    def spans(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the units."""
        return word_spans(raw) if self.words else (np.arange(len(raw)), np.arange(1, len(raw) + 1))

    def split(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the units, and the hash of the gram that begins at each (of those that fit)."""
        if self.words:
            starts, ends, units = word_hashes(raw)
        else:
            starts = np.arange(len(raw))
            ends, units = starts + 1, raw.astype(np.uint64) + np.uint64(1)
        if len(units) < self.gram:
            return starts, ends, units[:0]
        grams, width, power = units, 1, BASE
        bits = bin(self.gram)[3:]
        for bit in bits:  # doubling: a gram of 2w from two of w, then one unit more where needed
            grams = grams[:-width] * np.uint64(power) + grams[width:]
            width, power = 2 * width, power * power % (1 << 64)
            if bit == "1":
                grams = grams[:-1] * np.uint64(BASE) + units[width:]
                width, power = width + 1, power * BASE % (1 << 64)
        return starts, ends, mixed(grams)

    def anchors(self, grams: np.ndarray) -> np.ndarray:
        """For every window, the place of its anchor: the first gram with the smallest upper bits."""
        width = self.window - self.gram + 1
        out = np.empty(max(0, len(grams) - width + 1), np.int32)
        for at in range(0, len(out), self.places // 2):  # the lower bits hold the place in a stretch
            stretch = grams[at : at + self.places // 2 + width - 1]
            keys = self.upper_bits(stretch) | np.arange(len(stretch), dtype=np.uint64)
            done = 1
            while done < width:
                step = min(done, width - done)
                keys = np.minimum(keys[step:], keys[:-step])
                done += step
            out[at : at + len(keys)] = (keys & np.uint64(self.places - 1)).astype(np.int32) + at
        return out

    @property
    def places(self) -> int:
        """Room for two windows and more."""
        return 1 << max(16, (2 * self.window).bit_length())

    def upper_bits(self, grams: np.ndarray) -> np.ndarray:
        return grams & ~np.uint64(self.places - 1)


def squeeze(*columns: np.ndarray) -> bytes:
    """Integer columns of one length, byte planes of their differences, compressed."""
    n = len(columns[0])
    planes = [np.array([n, len(columns)], "<u8").tobytes()]
    for column in columns:
        differences = np.diff(column.astype(np.int64), prepend=np.int64(0))
        planes.append(differences.astype("<i8").view(np.uint8).reshape(n, 8).T.tobytes())
    return zstandard.compress(b"".join(planes), 1)


def unsqueeze(blob: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    n, k = raw[:16].view("<u8").tolist()
    shaped = raw[16:].reshape(k, 8, n)
    return [np.cumsum(np.ascontiguousarray(p.T).view("<i8").ravel()) for p in shaped]


def grouped(keys: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The columns by key; rows of a key keep their order."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    cuts = np.flatnonzero(np.diff(keys)) + 1
    parts = [np.split(c[order], cuts) for c in columns]
    for i, key in enumerate(keys[np.concatenate([[0], cuts])].tolist()):
        yield key, [p[i] for p in parts]


def group_of(docs: np.ndarray, groups: int) -> np.ndarray:
    return (mixed(docs.astype(np.int64).view(np.uint64)) % np.uint64(groups)).astype(np.int64)


def table_of(rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table([[r[0] for r in rows], [r[1] for r in rows]], schema=ROW)


def anchor_entries(units: Units, ids: np.ndarray, texts: list[bytes], buckets: int, groups: int):
    """Rows of one batch: entries by bucket, and known repeats by group of documents (as key -1 - group)."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    starts, _, grams = units.split(raw)
    of_window = units.anchors(grams)
    if units.words:
        doc = np.searchsorted(bounds, starts, "right")
    else:
        doc = np.repeat(np.arange(len(texts)), np.diff(bounds, prepend=0))[: len(starts)]
    inside = doc[: len(of_window)] == doc[units.window - 1 :]
    if not units.words:  # the byte that separates two documents is in neither
        separator = bounds[doc[: len(of_window)]] - 1
        inside &= starts[: len(of_window)] + units.window <= separator
    places = of_window[inside]
    if not len(places):
        return
    places = places[np.concatenate([[True], places[1:] != places[:-1]])]
    first_unit = np.searchsorted(doc, np.arange(len(texts)))
    owner = doc[places]
    names, spots, hashes = ids[owner], places - first_unit[owner], grams[places]
    order = np.argsort(hashes, kind="stable")
    runs = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
    several = np.zeros(len(hashes), bool)
    sizes = np.diff(np.append(runs, len(order)))
    several[order] = np.repeat(sizes > 1, sizes)
    first = np.zeros(len(hashes), bool)
    first[order[runs]] = True
    for group, (d, s) in grouped(group_of(names[several], groups), names[several], spots[several]):
        yield -1 - group, squeeze(d, s)
    sent = np.flatnonzero(first)
    bucket = (hashes[sent] >> HASH_BITS) % np.uint64(buckets)
    code = hashes[sent] & ((np.uint64(1) << HASH_BITS) - np.uint64(1))
    columns = (code, names[sent], spots[sent], several[sent].astype(np.int64))
    for key, packed in grouped(bucket.astype(np.int64), *columns):
        yield key, squeeze(*packed)


def repeated_entries(blobs: list[bytes], groups: int):
    """Of a bucket's entries, those whose anchor another batch has too, by group of documents."""
    code, doc, spot, several = (np.concatenate(c) for c in zip(*map(unsqueeze, blobs), strict=True))
    order = np.argsort(code, kind="stable")
    runs = np.flatnonzero(np.concatenate([[True], code[order][1:] != code[order][:-1]]))
    sizes = np.diff(np.append(runs, len(order)))
    shared = np.zeros(len(code), bool)
    shared[order] = np.repeat(sizes > 1, sizes)
    shared &= several == 0
    for group, (d, s) in grouped(group_of(doc[shared], groups), doc[shared], spot[shared]):
        yield group, squeeze(d, s)


def packed_contexts(
    contexts: list[bytes], docs: np.ndarray, counts: np.ndarray, starts: np.ndarray, codes: np.ndarray
) -> bytes:
    """counts: starts (with their codes) of each context."""
    numbers = squeeze(np.array([len(c) for c in contexts]), docs, counts)
    places = squeeze(starts, codes)
    text = zstandard.compress(b"".join(contexts), 3)
    return b"".join(len(x).to_bytes(8, "little") + x for x in (numbers, places, text))


def unpacked_contexts(blobs: list[bytes]) -> Contexts:
    contexts, columns, places = [], [], []
    for blob in blobs:
        parts, at = [], 0
        while at < len(blob):
            size = int.from_bytes(blob[at : at + 8], "little")
            parts.append(blob[at + 8 : at + 8 + size])
            at += 8 + size
        sizes, doc, counts = unsqueeze(parts[0])
        columns.append((doc, counts))
        places.append(unsqueeze(parts[1]))
        text, ends = zstandard.decompress(parts[2]), np.cumsum(sizes).tolist()
        contexts += [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    docs, counts = (np.concatenate(c) for c in zip(*columns, strict=True))
    starts, codes = (np.concatenate(c) for c in zip(*places, strict=True))
    return contexts, docs, counts, starts, codes


def stretches(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """firsts[0], firsts[0] + 1, ..., `counts[0]` of them, then those from firsts[1] on."""
    return np.repeat(firsts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def packed_spans(spans: Spans, groups: int) -> Iterator[tuple[int, bytes]]:
    """spans: one a row."""
    if len(spans):
        doc, *rest = np.asarray(spans, np.int64).T
        for group, columns in grouped(group_of(doc, groups), doc, *rest):
            yield group, squeeze(*columns)


def by_document(blobs: list[bytes]) -> dict[int, list[np.ndarray]]:
    """Columns after the first, by the document in the first."""
    if not blobs:
        return {}
    columns = [np.concatenate(c) for c in zip(*map(unsqueeze, blobs), strict=True)]
    return dict(grouped(columns[0], *columns[1:]))


def contexts_of_group(units: Units, docs: list[tuple[int, bytes]], spots: dict, buckets: int, groups: int):
    """Contexts of a group of documents by bucket; covered windows known here already as key -1 - group."""
    number: dict[bytes, int] = {}
    found: list[int] = []  # numbers of the contexts, as they come
    rows: list[np.ndarray] = []  # bucket, id, code, first window and number of windows of each
    for name, packed in sorted(docs, key=lambda d: d[0]):
        if name not in spots:
            continue
        raw = zstandard.decompress(packed)
        starts, ends, grams = units.split(np.frombuffer(raw, np.uint8))
        of_window = units.anchors(grams)
        if not len(of_window):
            continue
        repeats = np.zeros(len(starts), bool)
        spot = spots[name][0]
        repeats[spot[spot < len(starts)]] = True  # rows of one id may differ in length
        code = zlib.crc32(raw)
        firsts = np.flatnonzero(np.concatenate([[True], of_window[1:] != of_window[:-1]]))
        lasts = np.append(firsts[1:], len(of_window)) - 1
        mine = repeats[of_window[firsts]]
        firsts, lasts = firsts[mine], lasts[mine]
        bucket = (grams[of_window[firsts]] >> HASH_BITS) % np.uint64(buckets)
        low, high = starts[firsts].tolist(), ends[lasts + units.window - 1].tolist()
        found += [number.setdefault(raw[a:b], len(number)) for a, b in zip(low, high, strict=True)]
        row = np.empty((len(firsts), 5), np.int64)
        row[:, 0], row[:, 1], row[:, 2], row[:, 3], row[:, 4] = bucket, name, code, firsts, lasts - firsts + 1
        rows.append(row)
    if not found:
        return
    row, string, strings = np.concatenate(rows), np.array(found), list(number)
    # Numbers are handed out in order, so a context is new where its number is the next.
    first = np.flatnonzero(np.diff(np.maximum.accumulate(string), prepend=-1))
    own = row[:, 1] == row[first[string], 1]
    for group, blob in packed_spans(row[~own, 1:], groups):
        yield -1 - group, blob
    counts = np.bincount(string[own], minlength=len(strings))
    starts, codes = row[own, 3], row[own, 2]
    seen = np.argsort(string[own], kind="stable")
    firsts_of = np.cumsum(counts) - counts
    for key, (mine,) in grouped(row[first, 0], np.arange(len(strings))):
        places = seen[stretches(firsts_of[mine], counts[mine])]
        contexts = [strings[i] for i in mine.tolist()]
        yield key, packed_contexts(contexts, row[first[mine], 1], counts[mine], starts[places], codes[places])


def cleaned(units: Units, raw: bytes, spans: list[np.ndarray] | None) -> tuple[int, int, int, bytes]:
    """Units, those removed, runs of removed units, and what is left."""
    starts, ends = units.spans(np.frombuffer(raw, np.uint8))
    turns = np.zeros(len(starts) + 1, np.int64)
    if spans is not None:
        own = spans[0] == zlib.crc32(raw)
        first, windows = spans[1][own], spans[2][own]
        np.add.at(turns, first, 1)
        np.add.at(turns, first + windows + units.window - 1, -1)
    gone = np.cumsum(turns[:-1]) > 0
    runs = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
    if units.words:
        left = b" ".join([raw[a:b] for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist(), strict=True)])
    else:
        left = np.frombuffer(raw, np.uint8)[~gone].tobytes() if runs else raw
    return len(starts), int(gone.sum()), runs, left


def remove_repeats(
    docs: DataFrame,
    units: Units,
    index: Callable[[Contexts, int], Spans],
    id_col: str = "doc_id",
    text_col: str = "text",
    bytes_per_group: int = 8_000_000,
) -> DataFrame:
    """id, n_units, n_removed, n_spans, kept (bytes), one row per row of `docs`.

    index: called on the executors with the contexts of a bucket and the window, says which windows a smaller
    document has too. Null texts are empty. Rows of one id are not compared with each other, whether their texts
    are equal or not. Rows with a null id are not compared and keep their text. No rows: no rows.
    """
    source = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(total / bytes_per_group))
    buckets = groups

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            ids = batch["id"].to_numpy(zero_copy_only=False)
            rows = list(anchor_entries(units, ids, batch["text"].to_pylist(), buckets, groups))
            if rows:
                yield from table_of(rows).to_batches()

    def meet(table: pa.Table) -> pa.Table:
        key, blobs = table["key"][0].as_py(), table["blob"].to_pylist()
        if key < 0:
            return table_of([(-1 - key, b) for b in blobs])
        return table_of(list(repeated_entries(blobs, groups)))

    spots = source.filter("id IS NOT NULL").mapInArrow(first_pass, ROW_DDL).groupBy("key").applyInArrow(meet, ROW_DDL)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("packed", pa.binary())])
        for batch in small_batches(batches, "text", BATCH_BYTES):
            packed = [zstandard.compress(t, 3) for t in batch["text"].to_pylist()]
            ids = batch["id"]
            keys = group_of(ids.fill_null(0).to_numpy(), groups)
            yield pa.record_batch([pa.array(keys), ids, packed], schema=shape)

    packed = source.mapInArrow(compress, "key long, id long, packed binary")

    def show(left: pa.Table, right: pa.Table) -> pa.Table:
        found = by_document(right["blob"].to_pylist())
        texts = [d for d in zip(left["id"].to_pylist(), left["packed"].to_pylist(), strict=True) if d[0] is not None]
        return table_of(list(contexts_of_group(units, texts, found, buckets, groups)))

    contexts = packed.groupBy("key").cogroup(spots.groupBy("key")).applyInArrow(show, ROW_DDL)

    def decide(table: pa.Table) -> pa.Table:
        key, blobs = table["key"][0].as_py(), table["blob"].to_pylist()
        if key < 0:
            return table_of([(-1 - key, b) for b in blobs])
        return table_of(list(packed_spans(index(unpacked_contexts(blobs), units.window), groups)))

    spans = cut_lineage(contexts.groupBy("key").applyInArrow(decide, ROW_DDL))
    shape = pa.schema(
        [("id", pa.int64()), ("n_units", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
    )

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        found = by_document(right["blob"].to_pylist())
        rows = [
            (name, *cleaned(units, zstandard.decompress(text), None if name is None else found.get(name)))
            for name, text in zip(left["id"].to_pylist(), left["packed"].to_pylist(), strict=True)
        ]
        return pa.table([list(c) for c in zip(*rows, strict=True)] or [[]] * 5, schema=shape)

    return (
        packed.groupBy("key")
        .cogroup(spans.groupBy("key"))
        .applyInArrow(remove, "id long, n_units long, n_removed long, n_spans long, kept binary")
    )
