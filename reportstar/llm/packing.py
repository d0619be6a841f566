"""Best-fit packing of token sequences with a fixed number of open bins.

Each task reads its documents once and packs them as they come, looking a bounded window ahead: of each window the
longest pieces are placed first. Open bins are kept by free space in a bitset (an integer whose bit f says that a
bin with f free places is open): the best fit is the lowest set bit at or above the length. If nothing fits and all
bins are open, the fullest closes. Memory is the open bins and one window.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportstar.llm.hashing import small_batches

Encoder = Callable[[list[str]], list[list[int]]]
PACKED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)
LONG_TEXT = 100_000
AHEAD_BYTES = 8_000_000
SPECIAL = "<|endoftext|>"
# Fixed value: the id that ends a document.
END = 2


def byte_bpe_encoder(ranks_path: str, json_path: str) -> Encoder:
    """Ids of byte_bpe_50k.json. The same vocabulary as ranks gives the same ids several times faster; very long
    texts, and those that spell the special token, go through the file itself."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    whole = Tokenizer.from_file(json_path)

    def encode(texts: list[str]) -> list[list[int]]:
        return [
            whole.encode(t, add_special_tokens=False).ids
            if len(t) > LONG_TEXT or SPECIAL in t
            else fast.encode_ordinary(t)
            for t in texts
        ]

    return encode


class OpenBins:
    """At most `most` bins of `capacity`, by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free = 0  # bit f: a bin with f free places is open
        self.bins: dict[int, list[int]] = defaultdict(list)
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        name = self.bins[free].pop()
        if not self.bins[free]:
            self.free ^= 1 << free
        self.open -= 1
        return name

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of an item of 1 to `capacity`."""
        fitting = self.free >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            name = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            free, name = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.bins[left].append(name)
            self.free |= 1 << left
            self.open += 1
        return name, self.capacity - free


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: only a longer document is cut, and only its first piece is short."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def pack(
    docs: DataFrame,
    encoder: Callable[[], Encoder],
    capacity: int = 1024,
    open_bins: int = 512,
    ahead: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_tokens: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and tokens).

    encoder: called once per task, gives the function from texts to ids. Every document is its ids and the end id.
    A window is at most `ahead` documents. A sequence is packed by one task: its id is the partition's number and a
    count, so a rerun of the task gives the same. Null and empty texts are the end id alone; repeated rows are packed
    each; a null id stays null. No rows: no rows.
    """
    fields = [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ]
    schema = pa.schema([*fields, ("tokens", pa.list_(pa.int32()))] if with_tokens else fields)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins = encoder(), OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for batch in small_batches(batches, "text", AHEAD_BYTES):
            for at in range(0, batch.num_rows, ahead):
                part = batch.slice(at, ahead)
                pieces = []
                encoded = encode(part["text"].to_pylist())
                for doc, ids in zip(part["id"].to_pylist(), encoded, strict=True):
                    tokens = np.array([*ids, END], "<u4")
                    for piece, (start, length) in enumerate(cut(len(tokens), capacity)):
                        pieces.append((doc, piece, start, length, tokens[start : start + length]))
                places = {i: bins.place(pieces[i][3]) for i in sorted(range(len(pieces)), key=lambda i: -pieces[i][3])}
                rows = []
                for i, (doc, piece, start, length, held) in enumerate(pieces):
                    name, offset = places[i]
                    row = (doc, piece, start, length, zlib.crc32(held.tobytes()), base + name, offset)
                    rows.append((*row, held.view("<i4")) if with_tokens else row)
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)],
                    schema=schema,
                )

    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return narrow.mapInArrow(packed, PACKED + (", tokens array<int>" if with_tokens else ""))
