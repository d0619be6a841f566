"""Token counts of a unigram model, by dynamic programming on a trie.

The distinct pre-tokens of a batch (runs of bytes that are not ASCII white space, marked with the word-start
sign) are sorted, which lays their trie out level by level: a node is a prefix, and words that share it are
neighbours. The forward score of a prefix (best sum of piece scores that spells it) is computed once per node,
and the number of pieces on the best way is stored where a word ends. A document's count is the sum over its
pre-tokens.

The pieces come from a public vocabulary file. Their scores are the Zipf weights of their order in it; no
tokenizer is trained.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_START = "▁"
UNKNOWN_PENALTY = 10.0
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
COUNTED = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])


@cache
def zipf_pieces(path: str) -> tuple[tuple[str, float], ...]:
    """Whole-text pieces of a sentencepiece file, the k-th with the log of its share under Zipf's law."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    whole = math.log(sum(1 / (k + 1) for k in range(len(plain))))
    return tuple((piece, -math.log(k + 1) - whole) for k, piece in enumerate(plain))


def _spread(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class PieceTable:
    """Pieces by two rolling hashes of their characters (128 bits together)."""

    def __init__(self, pieces: Sequence[tuple[str, float]]):
        hashed = []
        for piece, score in pieces:
            one = two = np.uint64(0)
            with np.errstate(over="ignore"):
                for x in _spread(np.array([ord(c) for c in piece])):
                    one, two = one * FIRST + x, two * SECOND + x
            hashed.append((int(one), int(two), score))
        hashed.sort()
        self.one = np.array([h[0] for h in hashed], np.uint64)
        self.two = np.array([h[1] for h in hashed], np.uint64)
        self.score = np.array([h[2] for h in hashed])
        self.longest = max(len(p) for p, _ in pieces)
        self.unknown = float(self.score.min()) - UNKNOWN_PENALTY

    def find(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        return (self.one[at] == one) & (self.two[at] == two), at


def count_words(words: Sequence[str], table: PieceTable) -> np.ndarray:
    """Pieces in the best spelling of each word; `words` sorted and distinct.

    The higher score wins, then fewer pieces. A character that is no piece costs the lowest score less a
    penalty and counts as its UTF-8 bytes.
    """
    counts = np.zeros(len(words), np.int64)
    if not words:
        return counts
    lengths = np.array([len(w) for w in words])
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    starts = np.cumsum(lengths) - lengths
    node = np.zeros(len(words), np.int64)
    zero = np.zeros(1, np.uint64)
    # The last levels of the trie, nearest first: hashes, best score, pieces, parent.
    levels = [(zero, zero, np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64))]
    alive = np.arange(len(words))
    for depth in range(1, int(lengths.max()) + 1):
        alive = alive[lengths[alive] >= depth]
        code = codes[starts[alive] + depth - 1]
        above = node[alive]
        fresh = np.ones(len(alive), bool)
        fresh[1:] = (above[1:] != above[:-1]) | (code[1:] != code[:-1])
        node[alive] = np.cumsum(fresh) - 1
        parent, letter = above[fresh], code[fresh]
        mark = _spread(letter)
        one = levels[0][0][parent] * FIRST + mark
        two = levels[0][1][parent] * SECOND + mark
        best = np.full(len(parent), -np.inf)
        pieces = np.zeros(len(parent), np.int64)
        back, power_one, power_two = parent, FIRST, SECOND
        for length, (h1, h2, score, number, up) in enumerate(levels, 1):
            hit, at = table.find(one - h1[back] * power_one, two - h2[back] * power_two)
            total = np.where(hit, score[back] + table.score[at], -np.inf)
            if length == 1:
                alone = score[back] + table.unknown
                size = 1 + (letter >= 0x80) + (letter >= 0x800) + (letter >= 0x10000)
                best = np.where(hit, total, alone)
                pieces = number[back] + np.where(hit, 1, size)
            else:
                wins = (total > best) | ((total == best) & (number[back] + 1 < pieces) & hit)
                best = np.where(wins, total, best)
                pieces = np.where(wins, number[back] + 1, pieces)
            back = up[back]
            with np.errstate(over="ignore"):
                power_one, power_two = power_one * FIRST, power_two * SECOND
        levels = [(one, two, best, pieces, parent), *levels[: table.longest - 1]]
        ends = alive[lengths[alive] == depth]
        counts[ends] = pieces[node[ends]]
    return counts


def count_tokens(
    docs: DataFrame,
    pieces: Callable[[], Sequence[tuple[str, float]]],
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = 400_000,
    batch_bytes: int = 4_000_000,
) -> DataFrame:
    """id, n_words, n_tokens, one row per row of `docs`.

    pieces: called on the executors, gives (piece, log score). A task remembers at most `remembered` counted
    pre-tokens between batches and forgets all of them beyond that. Null and empty texts have no words and no
    tokens; repeated rows are counted each; a null id stays null. No rows: no rows.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable(pieces())
        known: dict[bytes, int] = {}

        def close(ids: list, split: list) -> pa.RecordBatch:
            fresh = set().union(*split) - known.keys()
            if len(known) + len(fresh) > remembered:
                known.clear()
                fresh = set().union(*split)
            spelled = sorted(WORD_START + w.decode() for w in fresh)
            cut = len(WORD_START)
            for word, n in zip(spelled, count_words(spelled, table).tolist(), strict=True):
                known[word[cut:].encode()] = n
            totals = [sum(map(known.__getitem__, words)) for words in split]
            return pa.record_batch([ids, [len(w) for w in split], totals], schema=COUNTED)

        for batch in batches:
            ids, split, size = [], [], 0
            for doc, text in zip(batch["id"].to_pylist(), batch["text"], strict=True):
                raw = text.as_py()
                ids.append(doc)
                split.append(raw.split())
                size += len(raw)
                if size >= batch_bytes:
                    yield close(ids, split)
                    ids, split, size = [], [], 0
            yield close(ids, split)

    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    return narrow.mapInArrow(counted, "id long, n_words long, n_tokens long")
