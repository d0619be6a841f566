"""Pairs of short texts and of repeated lines, whose signatures draw on few shingles."""

from __future__ import annotations

import random
from fractions import Fraction

from test_small_cases import documents

from reportstar.llm import near_dedup


def fresh(k, n):
    return [f"p{k}x{i}" for i in range(n)]


def short_pairs(n):
    """Texts and their copies with one or two words more; each pair has words of its own."""
    out = []
    for k in range(n):
        size, more = [(8, 1), (9, 1), (12, 2), (13, 2), (20, 3)][k % 5]
        base = fresh(k, size)
        out.append((" ".join(base), " ".join([*base, *fresh(f"{k}y", more)])))
    return out


def line_pairs(n):
    """A line of eight words 60 times, and the same with some repetitions of another line."""
    out = []
    for k in range(n):
        base = [*fresh(k, 8)] * 60
        out.append((" ".join(base), " ".join([*base, *[*fresh(f"{k}y", 8)] * (10 + k % 3)])))
    return out


def similarity(a, b):
    return near_dedup.probability_jaccard(*(near_dedup.weighted(t.encode(), 5) for t in (a, b)))


def test_few_shingles_have_as_many_independent_bits(spark):
    pairs = short_pairs(250) + line_pairs(50)
    assert all(0.79 < similarity(a, b) < 0.88 for a, b in pairs)
    rows = [(2 * k + i, t) for k, pair in enumerate(pairs) for i, t in enumerate(pair)]
    got = {r["id"]: r["class_id"] for r in near_dedup.near_groups(documents(spark, rows)).collect()}
    alike = [k for k, (a, b) in enumerate(pairs) if similarity(a, b) >= 0.8]
    assert len(alike) > 150
    missed = [k for k in alike if got[2 * k + 1] != 2 * k]
    assert not missed, f"{len(missed)} of {len(alike)}"


def test_exactly_the_threshold_is_similar(spark):
    """4k common of 5k shingles, by rational arithmetic 0.8; the sum of doubles is often below."""
    below = []
    for k in (3, 7, 9, 20, 31):
        base = fresh(f"t{k}", 4 * k + 4)
        pair = " ".join(base), " ".join([*base, *fresh(f"u{k}", k)])
        a, b = (set(near_dedup.weighted(t.encode(), 5)[0].tolist()) for t in pair)
        assert Fraction(len(a & b), len(a | b)) == Fraction(4, 5)
        below += [pair] if similarity(*pair) < 0.8 else []
    assert below
    rows = [(2 * k + i, t) for k, pair in enumerate(below) for i, t in enumerate(pair)]
    for largest in (1, 1000):
        got = near_dedup.near_groups(documents(spark, rows), largest_set=largest).collect()
        assert all(r["class_id"] == r["id"] // 2 * 2 for r in got)


def test_copies_around_the_threshold_meet_in_blocks(spark, monkeypatch):
    """One group of texts that are 0.7 to 0.85 alike: most pairs stay undecided by sketches, and classes equal those of
    all exact similarities, whether the group is one block or many."""
    draw = random.Random(5)
    texts = []
    for k in range(110):
        words, run, at = fresh("base", 200), draw.choice([8, 9, 10]), 10 + 18 * draw.randrange(10)
        words[at : at + run] = fresh(f"own{k}", run)
        texts.append(" ".join(words))
    sets = [near_dedup.weighted(t.encode(), 5) for t in texts]
    label = list(range(len(texts)))
    apart = 0
    for i in range(len(texts)):
        for j in range(i):
            alike = near_dedup.probability_jaccard(sets[i], sets[j])
            apart += 0.7 <= alike < 0.8
            if alike >= 0.8 and label[i] != label[j]:
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    assert apart > 1000 and len(set(label)) > 1
    docs = documents(spark, list(enumerate(texts)))
    for rows, size in ((512, 32_000_000), (9, 9_000)):
        monkeypatch.setattr(near_dedup, "BLOCK_ROWS", rows)
        monkeypatch.setattr(near_dedup, "BLOCK_BYTES", size)
        got = {r["id"]: r["class_id"] for r in near_dedup.near_groups(docs).collect()}
        assert [got[k] for k in range(len(texts))] == label
