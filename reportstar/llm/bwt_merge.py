"""Suffix-array deduplication by merging the Burrows-Wheeler transforms of shards.

In a bucket of `repeats`, the contexts are cut into shards, and each shard gets its suffix array and transform. The
transforms are merged by refining an interleave: after h rounds the interleave puts the suffixes of all
shards in the order of their first h bytes, without comparing any two suffixes. Each round is one stable
distribution of the interleave by the symbol that precedes each suffix; along with it go the blocks of suffixes
that share those h bytes, which are common prefixes as they grow. A block that one document alone has is settled and
takes no part in later rounds. After `window` rounds the blocks are the repeated intervals, and the smallest document
of a block covers the others' windows. Contexts that equal one of a smaller document need no rounds.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame

from reportstar.llm.repeats import Contexts, Spans, Units, remove_repeats, stretches

MOST_SHARDS = 256  # a shard's number is one byte of the interleave
SHARD_SIZE = 1 << 15
PART_SIZE = 1 << 17  # what is merged at a time: small enough for the cache of a core


def suffix_array(text: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
    """Order of all suffixes of several strings, each up to its own end (one place past its last byte).

    `text` holds symbols from 1, and 0 at every end; equal suffixes follow the order of their strings.
    """
    n = len(text)
    string_end = np.repeat(ends, np.diff(ends, prepend=-1))
    padded = np.concatenate([text, np.zeros(8, text.dtype)]).astype(np.uint64)
    left = (string_end - np.arange(n)).astype(np.int64)
    key = np.zeros(n, np.uint64)
    for k in range(6):  # six symbols of nine bits
        key = (key << np.uint64(9)) | np.where(left > k, padded[k : k + n], np.uint64(0))
    order = np.argsort(key, kind="stable")
    key = key[order]
    opens = np.concatenate([[True], key[1:] != key[:-1], [True]])
    rank = np.empty(n, np.int64)  # where the suffixes that are equal so far start
    rank[order] = np.maximum.accumulate(np.where(opens[:-1], np.arange(n), 0))
    width = 6
    places = np.flatnonzero(~(opens[:-1] & opens[1:]))
    while len(places) and width <= longest:  # only what is not alone yet is sorted further
        tied = order[places]
        further = np.zeros(len(tied), np.int64)
        on = left[tied] > width
        further[on] = rank[tied[on] + width] + 1
        key = rank[tied] * np.int64(n + 1) + further
        sort = np.argsort(key, kind="stable")
        key, tied = key[sort], tied[sort]
        order[places] = tied
        opens = np.concatenate([[True], key[1:] != key[:-1], [True]])
        rank[tied] = np.maximum.accumulate(np.where(opens[:-1], places, 0))
        places = places[~(opens[:-1] & opens[1:])]
        width *= 2
    return order


class Shard:
    """Suffixes and transform of some strings."""

    def __init__(self, strings: list[bytes], first: int):
        sizes = np.array([len(s) + 1 for s in strings])
        ends = np.cumsum(sizes) - 1
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int16) + 1
        text[ends] = 0
        # An end sorts before every byte, ends among themselves by string: those places come first.
        order = suffix_array(text, ends, int(sizes.max()))
        string = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.string = string + first
        self.offset = order - (ends - sizes + 1)[string]
        self.before = np.where(self.offset > 0, text[order - 1], 0)
        self.strings = len(strings)


SETTLE_EVERY = 4  # rounds between two looks for what has settled


def interleave(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the shard each suffix comes from, in the order of their first `depth` symbols, and the block of
    suffixes it shares these with."""
    z, block, _ = refined(shards, depth, None)
    return z, block


def refined(shards: list[Shard], depth: int, owner: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The interleave, its blocks, and which suffix (as the shards list them) stands where.

    owner: of each suffix. Then only suffixes of at least `depth` symbols are brought into order, and a block of one
    owner settles: more symbols only split it, and all that is made of it by a symbol in front has one owner too. What
    has settled is left out of later rounds and of the result. None: all suffixes, and nothing settles.
    """
    before = np.concatenate([s.before for s in shards])
    # Symbols by rank, the end is 0; one byte unless all 256 bytes occur.
    kinds, rank = np.unique(np.append(before, 0), return_inverse=True)
    symbol_of = rank[:-1].astype(np.uint8 if len(kinds) <= 256 else np.uint16)
    # The suffix that is longer by the symbol in front, in the same shard.
    longer = np.empty(len(before), np.int32)
    first = 0
    for s in shards:
        longer[first + np.argsort(symbol_of[first : first + len(s.before)], kind="stable")] = np.arange(
            first, first + len(s.before)
        )
        first += len(s.before)
    head = np.concatenate([np.full(s.strings, i, np.uint8) for i, s in enumerate(shards)])
    z = np.concatenate([np.full(len(s.before), i, np.uint8) for i, s in enumerate(shards)])
    firsts = np.cumsum([0, *(len(s.before) for s in shards[:-1])])
    end_suffixes = np.concatenate([np.arange(f, f + s.strings) for f, s in zip(firsts, shards, strict=True)])
    suffixes = np.arange(len(z), dtype=np.int32)  # as the shards list them
    if owner is not None:  # each round adds a symbol in front: what starts further left cannot take `depth` of them
        suffixes = np.flatnonzero(np.concatenate([s.offset for s in shards]) >= depth).astype(np.int32)
        z = z[suffixes]
    block = np.zeros(len(z), np.int32)
    place = np.arange(len(z))  # where they stand in the interleave
    for step in range(1, depth + 1):
        if not len(z):
            break
        symbol = np.empty(len(z), symbol_of.dtype)
        mine = symbol_of[suffixes]
        symbol[place] = mine
        moved = np.argsort(symbol, kind="stable")
        moved = moved[np.count_nonzero(mine == 0) :]
        came, sign = block[moved], symbol[moved]
        turn = np.ones(len(moved), bool)
        turn[1:] = (came[1:] != came[:-1]) | (sign[1:] != sign[:-1])
        z, block = z[moved], np.cumsum(turn, dtype=np.int32)
        suffixes = np.sort(longer[suffixes[mine > 0]])
        if owner is None:
            # Ends are all different and keep the order of their strings.
            z = np.concatenate([head, z])
            block = np.concatenate([np.arange(-len(head), 0, dtype=np.int32), block])
            suffixes = np.sort(np.concatenate([end_suffixes.astype(np.int32), suffixes]))
        place = np.argsort(z, kind="stable")
        if owner is not None and step % SETTLE_EVERY == 0:
            owners = np.empty(len(z), owner.dtype)
            owners[place] = owner[suffixes]
            mixed = np.zeros(len(z) + 2, bool)
            mixed[block[1:][(block[1:] == block[:-1]) & (owners[1:] != owners[:-1])]] = True
            stays = mixed[block]
            going_on = stays[place]
            suffixes, place = suffixes[going_on], (np.cumsum(stays) - 1)[place[going_on]]
            z, block = z[stays], block[stays]
    standing = np.empty(len(z), np.int32)
    standing[place] = suffixes
    return z, block, standing


def anchor_of(strings: list[bytes], window: int, gram: int) -> np.ndarray:
    """Hash of the anchor of each context, which all its windows share."""
    firsts = np.frombuffer(b"".join(s[:window] for s in strings), np.uint8)
    units = Units(window, gram, False)
    grams = units.split(firsts)[2]
    grams = np.append(grams, np.zeros(gram - 1, np.uint64)).reshape(-1, window)
    return units.upper_bits(grams[:, : window - gram + 1].min(axis=1))


def smallest_by_window(strings: list[bytes], smallest: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest document (of `smallest`, by string) that has each window, windows by string and place; and the
    number of windows of each string."""
    sizes = np.cumsum([len(s) + 1 for s in strings])
    per_shard = max(SHARD_SIZE, -(-int(sizes[-1]) // (MOST_SHARDS - 1)))
    cuts = np.searchsorted(sizes, np.arange(per_shard, int(sizes[-1]), per_shard)).tolist()
    edges = sorted({0, *cuts, len(strings)})
    shards = [Shard(strings[a:b], a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    string = np.concatenate([s.string for s in shards])
    offset = np.concatenate([s.offset for s in shards])
    _, block, standing = refined(shards, window, smallest[string])
    length = np.array([len(s) for s in strings])
    windows = length - window + 1
    out = np.repeat(smallest, windows)  # what has settled has no smaller document
    string, offset = string[standing], offset[standing]
    if len(block):
        opens = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        least = np.repeat(np.minimum.reduceat(smallest[string], opens), np.diff(np.append(opens, len(block))))
        out[(np.cumsum(windows) - windows)[string] + offset] = least
    return out, windows


def anchor_parts(strings: np.ndarray, kind: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """`strings`, which are in the order of their anchors, in parts of about PART_SIZE symbols; strings of one anchor,
    and only these can share windows, stay together."""
    starts = np.cumsum(sizes) - sizes
    opens = np.concatenate([[True], kind[strings[1:]] != kind[strings[:-1]]])
    part = np.maximum.accumulate(np.where(opens, starts, 0)) // PART_SIZE
    return np.split(strings, np.flatnonzero(part[1:] != part[:-1]) + 1)


def covered_windows(contexts: Contexts, window: int, gram: int) -> Spans:
    texts, docs, counts, starts, codes = contexts
    # Equal contexts are one string; whoever has it beyond the smallest document is an owner like the others.
    number: dict[bytes, int] = {}
    string_of = np.array([number.setdefault(t, len(number)) for t in texts])
    strings = list(number)
    smallest = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(smallest, string_of, docs)
    # A string that is alone with its anchor shares no window with any other.
    _, kind, kinds = np.unique(anchor_of(strings, window, gram), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(kinds[kind] > 1)
    shared = shared[np.argsort(kind[shared], kind="stable")]
    row = np.full(len(strings), -1)
    row[shared] = np.arange(len(shared))
    of = turned = lengths = np.empty(0, np.int64)  # runs of covered windows: row, first window, number of windows
    if len(shared):
        parts = [
            smallest_by_window([strings[i] for i in part], smallest[part], window)
            for part in anchor_parts(shared, kind, np.array([len(strings[i]) + 1 for i in shared]))
        ]
        least, windows = (np.concatenate(c) for c in zip(*parts, strict=True))
        first = np.cumsum(windows) - windows
        theirs = least < np.repeat(smallest[shared], windows)
        turns = np.zeros(len(theirs) + 1, bool)
        turns[1:-1] = theirs[1:] != theirs[:-1]
        turns[first] = turns[-1] = True  # no run goes beyond its string
        turned = np.flatnonzero(turns)
        lengths, turned = np.diff(turned), turned[:-1]
        lengths, turned = lengths[theirs[turned]], turned[theirs[turned]]
        of = np.searchsorted(first, turned, "right") - 1
        turned = turned - first[of]
    runs = np.append(np.bincount(of, minlength=len(shared)), 0)  # the last is for strings without a row
    # A context that a smaller document has too is covered whole, another one by the runs of its string.
    again = smallest[string_of] < docs
    its_row = row[string_of]
    spans = np.where(again, 1, runs[its_row])
    context = np.repeat(np.arange(len(texts)), spans)
    windows_of = np.array([len(t) for t in texts], np.int64)[context] - window + 1
    run = stretches((np.cumsum(runs) - runs)[its_row], spans)
    whole = again[context]
    at, size = np.zeros(len(context), np.int64), windows_of
    at[~whole], size[~whole] = turned[run[~whole]], lengths[run[~whole]]
    seen = stretches((np.cumsum(counts) - counts)[context], counts[context])
    span = np.repeat(np.arange(len(context)), counts[context])
    return np.column_stack([docs[context][span], codes[seen], starts[seen] + at[span], size[span]])


def remove_repeated_bytes(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", bytes_per_group: int = 8_000_000
) -> DataFrame:
    """id, n_units (bytes), n_removed, n_spans, kept (bytes; may end inside a character).

    A byte goes if it lies in `window` neighbouring bytes of its document that also occur in a document with a smaller
    id. Strings are judged on the input. See `repeats.remove_repeats` for nulls, repeated rows and empty tables;
    texts shorter than a window stay whole.
    """
    units = Units(window=window, gram=min(16, window), words=False)
    return remove_repeats(docs, units, partial(covered_windows, gram=units.gram), id_col, text_col, bytes_per_group)
