"""Substring deduplication on suffix automata of reference shards.

The reference of a document is every smaller document. Its shards are the buckets of `repeats`: a shard holds all
repeated passages that its anchors lead to. A task builds the shard's suffix automaton and streams the documents
that have an anchor there through it in order of id, for their matching statistics (the longest match that ends
at each word); windows whose match is long enough are covered. What a document has that is new then extends the
automaton. Shards would be broadcast whole only if the reference were bounded; here it is the corpus, so each
automaton stays in its task and the passages come to it.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame

from reportstar.llm.repeats import Contexts, Spans, Units, remove_repeats


class SuffixAutomaton:
    """Of several strings of hashable symbols."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, arcs: dict, link: int) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, origin: int, target: int, symbol) -> int:
        """The state for the strings that `origin` + symbol gives, apart from longer ones of `target`."""
        copy = self._state(self.length[origin] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while origin != -1 and self.next[origin].get(symbol) == target:
            self.next[origin][symbol] = copy
            origin = self.link[origin]
        return copy

    def add(self, text: list) -> None:
        last = 0
        for symbol in text:
            target = self.next[last].get(symbol)
            if target is not None:  # known from another string
                whole = self.length[target] == self.length[last] + 1
                last = target if whole else self._split(last, target, symbol)
                continue
            fresh = self._state(self.length[last] + 1, {}, 0)
            at = last
            while at != -1 and symbol not in self.next[at]:
                self.next[at][symbol] = fresh
                at = self.link[at]
            if at != -1:
                target = self.next[at][symbol]
                whole = self.length[target] == self.length[at] + 1
                self.link[fresh] = target if whole else self._split(at, target, symbol)
            last = fresh

    def matches(self, text: list) -> list[int]:
        """Length of the longest substring of the automaton's strings that ends at each symbol."""
        arcs, link, length = self.next, self.link, self.length
        at = matched = 0
        out = []
        for symbol in text:
            target = arcs[at].get(symbol)
            while target is None and at:
                at = link[at]
                matched = length[at]
                target = arcs[at].get(symbol)
            if target is not None:
                at = target
                matched += 1
            out.append(matched)
        return out


def runs(flags: list[bool]) -> list[tuple[int, int]]:
    """Start and length of the runs of true values."""
    out, at = [], 0
    for value, part in groupby(flags):
        size = sum(1 for _ in part)
        if value:
            out.append((at, size))
        at += size
    return out


def covered_windows(contexts: Contexts, window: int) -> Spans:
    texts, docs, counts, starts, codes = contexts
    bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
    automaton = SuffixAutomaton()
    words: dict[bytes, int] = {}
    first: dict[bytes, int] = {}  # the document that brought a passage, and so put all of it in the automaton
    found = []
    order = np.argsort(docs, kind="stable").tolist()
    for doc, mine in groupby(order, key=lambda i: int(docs[i])):
        fresh = []
        for i in mine:
            if first.setdefault(texts[i], doc) < doc:
                known = [(0, len(texts[i].split()) - window + 1)]
            else:
                text = [words.setdefault(w, len(words)) for w in texts[i].split()]
                matched = [m >= window for m in automaton.matches(text)[window - 1 :]]
                known = runs(matched)
                fresh += [text[a : a + n + window - 1] for a, n in runs([not k for k in matched])]
            seen = slice(bounds[i], bounds[i + 1])
            for at, size in known:
                found += [
                    (doc, c, s + at, size) for s, c in zip(starts[seen].tolist(), codes[seen].tolist(), strict=True)
                ]
        for text in fresh:  # only now: a document is not compared with itself
            automaton.add(text)
    return found


def remove_repeated_passages(
    docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", bytes_per_group: int = 8_000_000
) -> DataFrame:
    """id, n_units (words), n_removed, n_spans, kept (words joined by one space, as bytes).

    A word goes if it lies in `window` neighbouring words of its document that also occur, in that order, in a document
    with a smaller id. Windows are judged on the input. See `repeats.remove_repeats` for nulls, repeated rows
    and empty tables; texts shorter than a window keep all words.
    """
    units = Units(window=window, gram=min(5, window), words=True)
    return remove_repeats(docs, units, covered_windows, id_col, text_col, bytes_per_group)
