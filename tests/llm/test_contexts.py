"""Contexts of a group of documents as flat columns."""

from __future__ import annotations

import zlib

import numpy as np
import zstandard

from reportstar.llm.repeats import Units, contexts_of_group, group_of, stretches, unpacked_contexts, unsqueeze


def test_stretches():
    assert stretches(np.array([5, 9, 0]), np.array([2, 0, 3])).tolist() == [5, 6, 0, 1, 2]


def test_every_window_is_in_one_context_or_known_to_be_covered():
    units, buckets, groups = Units(6, 3, False), 3, 2
    shared = b"the passage that all of them share, word by word"
    texts = [(1, shared + b"." + shared), (2, b"abcdefgh" + shared), (2, shared), (3, shared), (4, b"short")]
    spots = {name: [np.arange(200)] for name, _ in texts}
    packed = [(name, zstandard.compress(text)) for name, text in texts]
    blobs: dict[int, list[bytes]] = {}
    for key, blob in contexts_of_group(units, packed, spots, buckets, groups):
        blobs.setdefault(key, []).append(blob)
    by_code = {(name, zlib.crc32(text)): text for name, text in texts}
    windows = []
    for key, found in blobs.items():
        if key < 0:
            for blob in found:
                for name, code, start, n in zip(*(c.tolist() for c in unsqueeze(blob)), strict=True):
                    assert group_of(np.array([name]), groups)[0] == -1 - key
                    windows += [(name, code, start + i) for i in range(n)]
                    assert any(by_code[name, code][start : start + n + 5] in text for other, text in texts if other < name)
            continue
        contexts, docs, counts, starts, codes = unpacked_contexts(found)
        assert len(contexts) == len(docs) == len(counts) == len(set(contexts))
        at = 0
        for context, name, count in zip(contexts, docs.tolist(), counts.tolist(), strict=True):
            for start, code in zip(starts[at : at + count].tolist(), codes[at : at + count].tolist(), strict=True):
                assert by_code[name, code][start : start + len(context)] == context
                windows += [(name, code, start + i) for i in range(len(context) - 5)]
            at += count
        assert at == len(starts) == len(codes)
    want = [(*key, i) for key, text in by_code.items() for i in range(len(text) - 5)]
    assert sorted(windows) == sorted(want)
