"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, against
brute force in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportstar.llm import (
    bwt_merge,
    cotraining,
    exact_dedup,
    mixing,
    near_dedup,
    packing,
    queries,
    repeats,
    sharding,
    suffix_automaton,
    token_counts,
    topk,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use themselves.
    "id long, key string, record string, shard int, slot int, digest string, kept boolean, node long, size long, tokens int, epoch int"
)
EXTRA = (7, "k", "r", 1, 2, "d", True, 3, 4, 5, 6)


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None, *EXTRA) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def words(n, seed=0, vocabulary=500):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}é" for _ in range(n))


PASSAGE = words(70, 1)
ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "one"),
    (5, "one two three four"),
    (6, words(30, 2)),
    (7, words(30, 2)),
    (7, words(30, 2)),
    (8, words(20, 3) + " " + PASSAGE),
    (9, PASSAGE + "\n" + words(9, 4)),
    (9, words(5, 5)),
    (-3, PASSAGE.replace(" ", "  ", 3)),
    (None, PASSAGE),
    (None, None),
    (12, words(40_000, 6)),
    (13, "a" * 30_000),
    (14, "the " * 3000),
    (15, words(30, 2) + " changed"),
    (16, "\0\0 <|endoftext|>   𝔘nicode"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD)


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark, ODD).filter("false")


def collected(df):
    return [tuple(r) for r in df.collect()]


# Exact dedup


def expected_groups(rows):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[text or ""].append(doc)
    out = []
    for doc, text, *_ in rows:
        mine = groups[text or ""]
        keep = max((d for d in mine if d is not None), default=None)
        out.append((doc, keep, len(mine), doc == keep))
    return Counter(out)


@pytest.mark.parametrize(
    "digest",
    [exact_dedup.sha256, lambda t: F.lit("same").substr(1, 4), lambda t: F.substring(F.md5(t), 1, 1)],
    ids=["sha256", "one digest for all", "few digests"],
)
def test_exact_groups(odd, digest):
    found = exact_dedup.exact_groups(odd, digest=digest)
    got = Counter(collected(found.select("id", "keep_id", "group_size", "kept")))
    assert got == expected_groups(ODD)


def test_exact_groups_in_many_small_batches(odd):
    found = exact_dedup.exact_groups(odd, files_per_batch=1)
    assert Counter(collected(found.select("id", "keep_id", "group_size", "kept"))) == expected_groups(ODD)


def test_exact_dedup_keeps_one_row_of_each_text(odd, nothing):
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    got = Counter((t or "", d) for d, t, *_ in collected(kept))
    largest = {}
    for doc, text in ODD:
        known = largest.get(text or "")
        largest[text or ""] = doc if known is None else known if doc is None else max(known, doc)
    assert got == Counter(largest.items())
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert exact_dedup.deduplicated(nothing).count() == 0


# Sharding


def check_shards(rows, shards):
    by_shard = defaultdict(list)
    for _, size, shard, slot in rows:
        by_shard[shard].append((slot, size))
    for placed in by_shard.values():
        assert sorted(s for s, _ in placed) == list(range(len(placed)))
    total = sum(r[1] for r in rows)
    largest = max(r[1] for r in rows)
    for k in range(shards):
        assert abs(sum(s for _, s in by_shard[k]) - total / shards) <= largest


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards_are_equal_stretches(spark, odd, shards):
    many = documents(spark, [(i, "copy of one text" if i % 3 else words(i % 50, i)) for i in range(600)])
    for docs, n in ((odd, len(ODD)), (many, 600)):
        placed = sharding.shard_documents(docs, shards)
        assert placed.select("record.*").columns == docs.columns
        rows = collected(placed.select("record.doc_id", "size", "shard", "slot"))
        assert len(rows) == n
        check_shards(rows, shards)


def test_sharding_places_by_key_whatever_the_ranges(spark):
    rows = [(i, words(i % 30, i // 4)) for i in range(300)] + [(5, "same")] * 40
    placed = sharding.shard_documents(documents(spark, rows), 7, rows_per_range=10)
    got = Counter(collected(placed.select("record.doc_id", "record.text", "shard")))
    order = sorted(rows, key=lambda r: (hashlib.md5(r[1].encode()).hexdigest(), r[0]))
    total, before, want = sum(len(t.encode()) + 16 for _, t in rows), 0, Counter()
    for doc, text in order:
        want[(doc, text, before * 7 // total)] += 1
        before += len(text.encode()) + 16
    assert got == want


def test_overfull_ranges_are_split(spark):
    keyed = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("m"), F.lpad("id", 5, "0"))).otherwise(F.md5(F.col("id").cast("string"))).alias("key"),
        F.when(F.col("id") % 3 == 0, 500).otherwise(10).alias("size"),
    )
    splitters = sharding.split_ranges(keyed, 4000, 20, draws_per_piece=2)
    counted = keyed.groupBy(sharding.range_of(F.col("key"), splitters).alias("range")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    total = keyed.agg(F.sum("size")).first()[0]
    for row in counted.collect():
        assert row["size"] / total / 2 + row["n"] / 4000 / 2 <= 2 / 20


def test_no_documents_no_shards(nothing):
    assert sharding.shard_documents(nothing, 4).count() == 0


def test_op10_contract(spark, tmp_path):
    documents(spark, ODD).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op10_sharding(spark, str(tmp_path)).collect()
    texts = Counter((d, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for d, t in ODD)
    assert Counter((r["doc_id"], r["text_crc32"], r["size"]) for r in rows) == texts
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


# Top k


def brute_top_k(vectors, k, every):
    sound = []
    for name, v in vectors:
        if name is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            sound.append((name, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    best = defaultdict(list)
    for q, a in sound:
        if q % every == 0:
            best[q] += [(-sum(x * y for x, y in zip(a, b)), c) for c, b in sound if c != q and len(a) == len(b)]
    return sorted((q, i + 1, c, -s) for q, found in best.items() for i, (s, c) in enumerate(sorted(found)[:k]))


def test_top_k(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, rng.normal(size=8).astype(float).tolist()) for i in range(400)]
    vectors += [(i, [1.0] * 8) for i in range(400, 430)]  # ties
    vectors += [(500, None), (550, [1.0, None] + [0.0] * 6), (600, [float("nan")] * 8), (650, [float("inf")] * 8)]
    vectors += [(None, [1.0] * 8), (700, [1.0, 2.0]), (701, [2.0, -1.0]), (750, []), (50, [0.5] * 8), (51, vectors[51][1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumns(
        {"rank": F.lit(1), "score": F.lit(2), "id": F.lit(3)}
    )
    for setting in ({}, {"block": 4, "rows_per_cell": 50, "queries_per_cell": 3}):
        got = sorted(collected(topk.exact_top_k(df, every=50, **setting)))
        assert got == brute_top_k(vectors, 5, 50)
    assert topk.exact_top_k(df.filter("false")).count() == 0


def test_top_k_skips_blocks_below_the_kth(monkeypatch):
    scored = []
    real = topk.products
    monkeypatch.setattr(topk, "products", lambda a, b: scored.append(len(b)) or real(a, b))
    rows = np.repeat(np.arange(64)[:, None], 4, axis=1) * 1000
    topk.best_of_cell(np.ones((1, 4), np.int64), np.array([-1]), rows, np.arange(64), 2, 8)
    assert scored[2:] == [8]  # after the two products of the bounds: one block of eight


# Packing


def byte_encoder():
    return lambda: lambda texts: [list(t.encode()) for t in texts]


@pytest.mark.parametrize("encoder", [byte_encoder(), queries.byte_bpe], ids=["bytes", "byte_bpe"])
def test_packing_round_trip(odd, nothing, encoder):
    encode = encoder()
    rows = packing.pack(odd, encoder).collect()
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["length"] == len(r["tokens"]) <= 1024
        assert r["ids_crc32"] == zlib.crc32(np.array(r["tokens"], "<u4").tobytes())
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    want = Counter((d, tuple([*encode([t or ""])[0], packing.END])) for d, t in ODD)
    whole = Counter()
    for doc, mine in pieces.items():
        runs = []
        for r in sorted(mine, key=lambda r: (r["piece"], r["start"])):
            assert r["piece"] == 0 or r["length"] == 1024
        if sum(d == doc for d, _ in ODD) == 1:
            joined = [t for r in sorted(mine, key=lambda r: r["piece"]) for t in r["tokens"]]
            assert [r["start"] for r in sorted(mine, key=lambda r: r["piece"])][0] == 0
            runs.append(tuple(joined))
            whole.update((doc, x) for x in runs)
    single = Counter({k: n for k, n in want.items() if sum(d == k[0] for d, _ in ODD) == 1})
    assert whole == single
    assert sum(r["length"] for r in rows) == sum(len(k[1]) * n for k, n in want.items())
    assert packing.pack(nothing, encoder).count() == 0


def test_encoder_gives_the_ids_of_the_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(queries.BYTE_BPE))
    rng = random.Random(0)
    texts = [t or "" for _, t in ODD] + ["".join(chr(rng.choice([32, 10, 65, 97, 233, 0x4E00, 0x1F600, 39, 48])) for _ in range(80)) for _ in range(300)]
    assert queries.byte_bpe()(texts) == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_best_fit_and_the_fullest_closes():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0)  # 4 free
    assert bins.place(7) == (1, 0)  # 3 free
    assert bins.place(3) == (1, 7)  # the best fit, now full
    assert bins.place(7) == (2, 0)
    assert bins.place(9) == (3, 0)  # two were open: bin 2, the fullest, closed
    assert bins.place(3) == (0, 6)
    assert bins.place(1) == (0, 9)


def test_packing_is_tight():
    rng = random.Random(1)
    bins, total = packing.OpenBins(1024, 512), 0
    for _ in range(20_000):
        size = min(1024, int(rng.lognormvariate(5.5, 1)) + 1)
        total += size
        bins.place(size)
    assert bins.made <= 1.02 * total / 1024


# Token counts


def test_token_counts_equal_a_unigram_tokenizer(odd, nothing):
    from tokenizers import Tokenizer, models

    pieces = list(queries.unigram_pieces())
    bytes_ = [(f"<0x{b:02X}>", -1000.0) for b in range(256)]
    model = models.Unigram([("<unk>", -1000.0), *pieces, *bytes_], 0, True)
    reference = Tokenizer(model)
    table = token_counts.PieceTable(pieces)
    rng = random.Random(0)
    letters = "abcdeéstuing漢𝔘́-1"
    spelled = sorted({token_counts.WORD_START + "".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(3000)})
    got = token_counts.count_words(spelled, table)
    plain = [i for i, w in enumerate(spelled) if all(c in {p for p, _ in pieces} for c in set(w))]
    assert len(plain) > 100
    for i in plain:
        assert got[i] == len(reference.encode(spelled[i]).ids), spelled[i]
    counted = Counter(collected(token_counts.count_tokens(odd, queries.unigram_pieces, remembered=50, batch_bytes=100)))
    want = Counter()
    for doc, text in ODD:
        split = (text or "").encode().split()
        numbers = [int(token_counts.count_words([token_counts.WORD_START + w.decode()], table)[0]) for w in split[:200]]
        if len(split) <= 200:
            want[(doc, len(split), sum(numbers))] += 1
    assert want - counted == Counter()
    assert sum(counted.values()) == len(ODD)
    assert token_counts.count_tokens(nothing, queries.unigram_pieces).count() == 0


def test_unknown_characters_count_as_bytes():
    table = token_counts.PieceTable([(token_counts.WORD_START, -1.0), ("a", -1.0), ("aa", -1.5), ("ab", -2.0)])
    got = token_counts.count_words(sorted(["▁a", "▁aa", "▁ab", "▁aaa", "▁漢", "▁b"]), table)
    assert dict(zip(sorted(["▁a", "▁aa", "▁ab", "▁aaa", "▁漢", "▁b"]), got.tolist())) == {
        "▁a": 2, "▁aa": 2, "▁ab": 2, "▁aaa": 3, "▁b": 2, "▁漢": 4,
    }


# Repeats


def brute_repeats(rows, window, by_words):
    def split(text):
        raw = (text or "").encode()
        return raw.split() if by_words else [raw[i : i + 1] for i in range(len(raw))]

    first: dict = {}
    for doc, text in rows:
        units = split(text)
        for k in range(len(units) - window + 1 if doc is not None else 0):
            w = tuple(units[k : k + window])
            first[w] = min(first.get(w, doc), doc)
    out = Counter()
    for doc, text in rows:
        units = split(text)
        gone = [False] * len(units)
        for k in range(len(units) - window + 1 if doc is not None else 0):
            if first[tuple(units[k : k + window])] < doc:
                gone[k : k + window] = [True] * window
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        left = [u for u, g in zip(units, gone) if not g]
        out[(doc, len(units), sum(gone), spans, (b" " if by_words else b"").join(left))] += 1
    return out


@pytest.mark.parametrize("operator, window, by_words", [
    (suffix_automaton.remove_repeated_passages, 13, True),
    (bwt_merge.remove_repeated_bytes, 50, False),
])
def test_repeats(odd, nothing, operator, window, by_words):
    short = [r for r in ODD if len(r[1] or "") < 20_000]
    for rows, settings in ((short, {}), (short, {"bytes_per_group": 500})):
        docs = odd.filter(F.coalesce(F.length("text"), F.lit(0)) < 20_000)
        got = Counter((*r[:4], bytes(r[4])) for r in collected(operator(docs, window, **settings)))
        assert got == brute_repeats(rows, window, by_words)
    assert operator(odd, window).count() == len(ODD)
    assert operator(nothing, window).count() == 0


def test_repeats_of_many_documents(spark):
    passages = [words(40, 100 + i) for i in range(4)]
    rows = [(i, words(i % 40, i) + " " + passages[i % 4 if i % 3 else 0] + " " + words(i % 7, -i)) for i in range(150)]
    docs = documents(spark, rows)
    for operator, window, by_words in (
        (suffix_automaton.remove_repeated_passages, 13, True),
        (bwt_merge.remove_repeated_bytes, 50, False),
    ):
        got = Counter((*r[:4], bytes(r[4])) for r in collected(operator(docs, window, bytes_per_group=2000)))
        assert got == brute_repeats(rows, window, by_words)


def test_merged_shards_order_suffixes_as_sorting_does():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 30))) for _ in range(60)]
    cuts = [0, 11, 12, 40, 60]
    shards = [bwt_merge.Shard(strings[a:b], a) for a, b in zip(cuts, cuts[1:])]
    z, block = bwt_merge.interleave(shards, 7)
    at, got = [0] * len(shards), []
    for s in z.tolist():
        got.append((int(shards[s].string[at[s]]), int(shards[s].offset[at[s]])))
        at[s] += 1
    depth = [(strings[s][o : o + 7], s, o) for s, o in got]
    prefixes = [d[0] for d in depth]
    plain = sorted(((strings[s][o:], s, o) for s in range(60) for o in range(len(strings[s]) + 1)), key=lambda x: (x[0][:7],))
    assert [p[0][:7] for p in plain] == prefixes
    for i in range(1, len(got)):
        same = len(prefixes[i]) == 7 and prefixes[i] == prefixes[i - 1]
        assert (block[i] == block[i - 1]) == same


@pytest.mark.parametrize("n", [0, 6, 7, 40, 70_000, 200_000])
def test_anchors_are_the_first_smallest_grams(n):
    units = repeats.Units(window=10, gram=4, words=False)
    grams = np.random.default_rng(n).integers(0, 50, n).astype(np.uint64) << np.uint64(17)
    width = 7
    want = [] if n < width else np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1) + np.arange(n - width + 1)
    assert units.anchors(grams).tolist() == list(want)


@pytest.mark.parametrize("shard, part", [(20, 40), (64, 1 << 17), (1 << 15, 1 << 17)])
def test_least_documents_do_not_depend_on_what_has_settled(monkeypatch, shard, part):
    monkeypatch.setattr(bwt_merge, "SHARD_SIZE", shard)
    monkeypatch.setattr(bwt_merge, "PART_SIZE", part)
    rng = random.Random(5)
    for window in (3, 9, 14):
        strings = list({bytes(rng.choice(b"ab") for _ in range(rng.randint(window, 40))) for _ in range(40)})
        docs = np.array([rng.randint(0, 6) for _ in strings])
        least, windows = bwt_merge.smallest_by_window(strings, docs, window)
        assert windows.tolist() == [len(s) - window + 1 for s in strings]
        first = {}
        for s, d in zip(strings, docs.tolist()):
            for i in range(len(s) - window + 1):
                first[s[i : i + window]] = min(d, first.get(s[i : i + window], d))
        assert least.tolist() == [first[s[i : i + window]] for s in strings for i in range(len(s) - window + 1)]


# Near-duplicates


def brute_classes(rows):
    shown = {}
    for doc, text in rows:
        if doc is not None:
            digest = hashlib.sha256((text or "").encode()).hexdigest()
            shown[doc] = min(shown.get(doc, (digest, text or "")), (digest, text or ""))
    texts = defaultdict(list)
    for doc, text in rows:
        if doc is not None:
            texts[text or ""].append(doc)
    docs = sorted(shown)
    label = {d: d for d in docs}

    def join(a, b):
        low, high = sorted((label[a], label[b]))
        for d in docs:
            if label[d] == high:
                label[d] = low

    for same in texts.values():
        for d in same:
            join(same[0], d)
    weights = {d: near_dedup.weighted(shown[d][1].encode(), 5) for d in docs}
    for i, a in enumerate(docs):
        for b in docs[:i]:
            if near_dedup.probability_jaccard(weights[a], weights[b]) >= 0.8:
                join(a, b)
    return label


def near_copies(n, seed):
    rng = random.Random(seed)
    base = words(200, seed).split()
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(len(copy))] = f"x{rng.random()}"
        out.append(" ".join(copy))
    return out


def test_near_groups(spark, odd, nothing):
    label = brute_classes(ODD)
    got = {(r["id"], r["class_id"]) for r in near_dedup.near_groups(odd).collect()}
    assert {(d, c) for d, c in got if d is not None} == set(label.items())
    assert near_dedup.near_groups(odd).count() == len(ODD)
    assert near_dedup.near_groups(nothing).count() == 0


@pytest.mark.parametrize("largest", [2, 5, 1000])
def test_near_groups_of_every_size(spark, largest):
    texts = [t for k in range(6) for t in near_copies(3 + 4 * k, k)] + [words(60, 50 + i) for i in range(20)]
    texts += [PASSAGE[:60] + " " + words(12, 90 + i) for i in range(30)]
    rows = list(enumerate(texts))
    random.Random(0).shuffle(rows)
    got = {r["id"]: r["class_id"] for r in near_dedup.near_groups(documents(spark, rows), largest_set=largest).collect()}
    assert got == brute_classes(rows)


def test_probability_jaccard_and_its_estimate():
    a, b = near_dedup.weighted(words(900, 1, 60).encode(), 2), near_dedup.weighted((words(600, 1, 60) + words(300, 2, 60)).encode(), 2)
    x, y = dict(zip(a[0].tolist(), a[1])), dict(zip(b[0].tolist(), b[1]))
    direct = sum(
        1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys()
    )
    assert near_dedup.probability_jaccard(a, b) == pytest.approx(direct)
    registers = near_dedup.signatures(
        np.repeat([0, 1], [len(a[0]), len(b[0])]), np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), 2, 4096
    )
    assert (registers[0] == registers[1]).mean() == pytest.approx(direct, abs=0.03)


# Mixing


def test_mix_meets_its_targets(spark, nothing):
    rows = [(i, words(i % 60, i), "big") for i in range(900)] + [(1000 + i, words(20, i), f"s{i % 4}") for i in range(120)]
    rows += [(5000, None, "tiny"), (5001, "x y", "tiny"), (None, "n n", None), (None, "", None), (7, words(7, 7), "big")]
    docs = documents(spark, rows)
    for setting in ({"repeat_limit": 3.0}, {"repeat_limit": None, "target_entropy": 1.2}, {"repeat_limit": 2.0, "budget": 20_000}):
        out = mixing.mix_sources(docs, block_tokens=500, **setting).collect()
        size = {d: len((t or "").encode().split()) + 1 for d, t, _ in rows}
        most = 1 + max(size.values())
        held = Counter()
        for _, t, s in rows:
            held[s or ""] += len((t or "").encode().split()) + 1
        got, target = Counter(), {}
        for r in out:
            got[r["mix_source"]] += r["tokens"]
            target[r["mix_source"]] = r["target_tokens"]
        for source, want in target.items():
            assert want <= got[source] < want + 2 * most
        if "budget" in setting:
            assert sum(target.values()) == pytest.approx(20_000, abs=10)
        else:
            assert set(target) == set(held)
            assert target["big"] == pytest.approx(held["big"], abs=1)
        if setting["repeat_limit"] == 3.0:
            assert max(target[s] / held[s] for s in held) == pytest.approx(3, rel=0.05)
        if "target_entropy" in setting:
            p = np.array([target[s] for s in target]) / sum(target.values())
            assert -(p * np.log(p)).sum() == pytest.approx(1.2, abs=0.02)
        # Whole permutations first: no document is seen an epoch more than one of its source that is seen less.
        seen = defaultdict(set)
        for r in out:
            seen[(r["mix_source"], r["record"]["doc_id"])].add(r["epoch"])
        for epochs in seen.values():
            assert epochs == set(range(len(epochs)))
    assert mixing.mix_sources(nothing).count() == 0
    alone = mixing.mix_sources(documents(spark, [(1, "a b"), (2, None)]))
    assert sorted(r["record"]["doc_id"] for r in alone.collect()) == [1, 2]
    assert alone.select("record.*").columns == docs.columns


# Classifier


def labelled_corpus(spark, n=600):
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = words(60, i)
        rows.append((i, " ".join(f"{w}{rng.choice('###$$$%%%')}" for w in text.split()) if bad else text))
        if i % 3:
            labels.append((i, int(not bad)))
    return rows, labels


def test_classifier_on_held_out_documents(spark, odd, nothing):
    rows, labels = labelled_corpus(spark)
    docs = documents(spark, rows)
    known = spark.createDataFrame([*labels, (1, None), (None, 1), (10**9, 0)], "doc_id long, quality int")
    model = cotraining.fit_quality(docs, known)
    scored = {r["record"]["doc_id"]: r["p_good"] for r in cotraining.score_quality(docs, model).collect()}
    taught = {d for d, _ in labels}
    right = [(scored[d] >= 0.5) == (d % 4 != 0) for d, _ in rows if d not in taught]
    assert len(right) == 200 and sum(right) / len(right) >= 0.97
    out = cotraining.score_quality(odd, model)
    assert out.select("record.*").columns == odd.columns
    assert all(0 <= r["p_good"] <= 1 for r in out.collect())
    assert cotraining.score_quality(nothing, model).count() == 0


@pytest.mark.parametrize("label, kept", [(None, True), (1, True), (0, False)])
def test_classifier_without_two_classes(spark, odd, label, kept):
    rows = [] if label is None else [(6, label), (8, label)]
    model = cotraining.fit_quality(odd, spark.createDataFrame(rows, "doc_id long, quality int"))
    assert {r["p_good"] >= 0.5 for r in cotraining.score_quality(odd, model).collect()} == {kept}


def test_pseudo_labels_teach_the_other_view():
    rng = np.random.default_rng(0)
    y = np.arange(400) % 2
    content = rng.normal(size=(400, 3)) + 2 * y[:, None]
    metadata = rng.normal(size=(400, 2)) + 2 * y[:, None]
    alone = cotraining.co_train((content[:30], metadata[:30]), y[:30], (content[:0], metadata[:0]))
    taught = cotraining.co_train((content[:30], metadata[:30]), y[:30], (content[30:300], metadata[30:300]))
    accuracy = lambda m: ((m.score(content[300:], metadata[300:])[:, 2] >= 0.5) == y[300:]).mean()
    assert accuracy(taught) >= max(0.95, accuracy(alone) - 0.02)
