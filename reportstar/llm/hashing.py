"""Hashes of words and byte windows, computed for a whole batch of texts at once.

Words are maximal runs of bytes other than ASCII white space. A word's hash is a polynomial in its bytes modulo
2^64, taken from prefix sums, so that the cost is a few passes over the bytes however long the words are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, factor in enumerate((BASE, INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Sums of byte * BASE^i over the bytes before each place (one longer than `raw`)."""
    up, _ = powers(len(raw))
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def spans_hashed(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of `raw`."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~BLANK[raw]
    turns = np.diff(inside)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words."""
    starts, ends = word_spans(raw)
    return starts, ends, spans_hashed(prefix_sums(raw), starts, ends)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def small_batches(
    batches: Iterator[pa.RecordBatch], text: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """The rows again in batches of at most `most_bytes` of the binary column `text`, or of one row."""
    for batch in batches:
        sizes = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in batch[text]])
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + most_bytes, "right")))
            yield batch.slice(start, end - start)
            start = end
