"""Quality rules with verdicts on hosts.

Each document is measured by rules on its words and lines, inside its row. Failures are summed per host, the failure
rates are shrunk towards what hosts are like in general (a beta prior fitted to all hosts), and the verdict on a host
goes back to its documents: a trusted host's documents have to pass the base rules only, a watched host's documents
all rules, and a blocked host's documents go.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.llm.columns import bound
from reportstar.sinks.store import cut_lineage

# Words are runs of anything but ASCII white space; symbols.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """In percent, but for least_words and the word lengths (code points)."""

    least_words: int = 50
    repeat_words: int = 50
    repeat_soft: int = 25
    symbols: int = 10
    dup_lines: int = 30
    short_word: int = 2
    long_word: int = 15
    # Shrunk failure rates of hosts from which they are watched, and blocked.
    watched: float = 0.02
    blocked: float = 0.5


def repeated_words(words: Column, code: Callable[..., Column] = F.xxhash64) -> Column:
    """Words in windows of three that occur twice or more, the first occurrence included.

    A window's code and place share one long, so that sorting longs brings equal codes together. Windows alone with
    their code are done; the others are believed if they have as many different words as codes, and compared word by
    word if not.
    """

    def text_at(i: Column) -> Column:
        return F.concat_ws(" ", *[F.get(words, i.cast("int") + k) for k in range(WINDOW)])  # words hold no blank

    def neighbours(sorted_: Column, alike: Callable[[Column, Column], Column]) -> Column:
        return F.filter(
            sorted_,
            lambda x, j: F.coalesce(alike(x, F.get(sorted_, j - 1)), F.lit(False))
            | F.coalesce(alike(x, F.get(sorted_, j + 1)), F.lit(False)),
        )

    def by_words(places: Column) -> Column:
        texts = F.sort_array(F.transform(places, lambda i: F.struct(text_at(i).alias("text"), i.alias("at"))))
        same = bound(texts, lambda t: neighbours(t, lambda x, y: x["text"] == y["text"]))
        return F.transform(same, lambda t: t["at"])

    def starts(mask: Column) -> Column:
        packed = F.transform(
            words,
            lambda w, i: code(w, *[F.get(words, i + k) for k in range(1, WINDOW)])
            .bitwiseAND(F.bitwise_not(mask))
            .bitwiseOR(i.cast("long")),
        )
        whole = F.slice(packed, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
        shared = bound(
            F.sort_array(whole), lambda p: neighbours(p, lambda x, y: x.bitwiseXOR(y).between(F.lit(0), mask))
        )

        def believed(found: Column) -> Column:
            codes = F.size(F.array_distinct(F.transform(found, lambda x: x.bitwiseAND(F.bitwise_not(mask)))))
            places = F.transform(found, lambda x: x.bitwiseAND(mask))
            texts = F.size(F.array_distinct(F.transform(places, text_at)))
            return F.when(codes == texts, places).otherwise(by_words(places))

        return F.sort_array(bound(shared, believed))

    def covered(so_far: Column, at: Column) -> Column:
        fresh = F.least(F.lit(WINDOW), at - so_far["last"])
        return F.struct(at.alias("last"), (so_far["covered"] + fresh).alias("covered"))

    # As many low bits as the places need.
    mask = F.pow(F.lit(2), F.length(F.bin(F.size(words).cast("long")))).cast("long") - 1
    start = F.struct(F.lit(-WINDOW).cast("long").alias("last"), F.lit(0).cast("long").alias("covered"))
    return F.aggregate(bound(mask, starts), start, covered, lambda s: s["covered"])


def measured(text: Column) -> Column:
    """Struct of COUNTS for a text that is not null."""

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    with_words = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return F.struct(
        bound(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words).alias("words"),
        bound(with_words, of_lines).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
    )


def rules(limits: Limits) -> tuple[Column, dict[str, Column]]:
    """Whether the base rules fail, and the further rules by name, on the columns COUNTS."""
    words = F.col("n_words")
    base = (words < limits.least_words) | (100 * F.col("n_repeat_words") > limits.repeat_words * words)
    further = {
        "repeats": 100 * F.col("n_repeat_words") > limits.repeat_soft * words,
        "symbols": 100 * F.col("n_symbols") > limits.symbols * words,
        "dup_lines": 100 * F.col("n_dup_lines") > limits.dup_lines * F.col("n_lines"),
        "word_length": (F.col("word_chars") < limits.short_word * words)
        | (F.col("word_chars") > limits.long_word * words),
    }
    return base, further


def measure_documents(
    docs: DataFrame,
    limits: Limits,
    host_col: str = "source",
    text_col: str = "text",
    payload: Sequence[Column] | None = None,
) -> DataFrame:
    """Each row of `docs` as `record` (its columns, or those of `payload`), host, COUNTS, base_failed, failed (by rule)."""
    record = F.struct(*payload) if payload is not None else F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    counted = docs.select(
        record.alias("record"),
        F.col(host_col).cast("string").alias("host"),
        measured(F.coalesce(F.col(text_col), F.lit(""))).alias("m"),
    ).select("record", "host", "m.words.*", "m.lines.*", "m.n_symbols")
    base, further = rules(limits)
    flags = F.struct(*[rule.alias(name) for name, rule in further.items()])
    return counted.select("record", "host", *COUNTS, base.alias("base_failed"), flags.alias("failed"))


def beta_prior(hosts: DataFrame) -> tuple[float, float | None]:
    """Mean failure rate, and how many documents the prior is worth, fitted by moments to hosts (docs, bad).

    The spread of the rates beyond chance gives the strength; None: there is none, so every host has the mean rate.
    """
    sums = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("docs").cast("double").alias("docs"),
        F.sum("bad").cast("double").alias("bad"),
        F.sum(F.col("docs").cast("double") * F.col("docs")).alias("squares"),
        F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("docs")).alias("spread"),
    ).first()
    if not sums["docs"]:
        return 0.0, None
    docs, mean, more = sums["docs"], sums["bad"] / sums["docs"], sums["hosts"] - 1
    chance = mean * (1 - mean)
    room = (docs - sums["squares"] / docs - more) * chance
    if room <= 0:
        return mean, None
    alike = (sums["spread"] - docs * mean * mean - more * chance) / room
    if alike <= 0:
        return mean, None
    return mean, 1 / min(alike, 1.0) - 1


def host_verdicts(measured_docs: DataFrame, limits: Limits) -> DataFrame:
    """host, docs, bad, failures by rule, rate (shrunk), verdict: one row per host (no host is a host of its own)."""
    rule_names = measured_docs.schema["failed"].dataType.names
    any_rule = F.col("base_failed")
    for name in rule_names:
        any_rule = any_rule | F.col(f"failed.{name}")
    hosts = cut_lineage(
        measured_docs.groupBy("host").agg(
            F.count("*").alias("docs"),
            F.count_if(any_rule).alias("bad"),
            F.struct(
                F.count_if("base_failed").alias("base"), *[F.count_if(f"failed.{n}").alias(n) for n in rule_names]
            ).alias("failures"),
        )
    )
    mean, strength = beta_prior(hosts)
    shrunk = (
        F.lit(mean)
        if strength is None
        else (F.col("bad") + F.lit(strength * mean)) / (F.col("docs") + F.lit(strength))
    )
    verdict = (
        F.when(F.col("rate") >= limits.blocked, "blocked")
        .when(F.col("rate") >= limits.watched, "watched")
        .otherwise("trusted")
    )
    return hosts.withColumn("rate", shrunk).withColumn("verdict", verdict)


def judge_documents(
    docs: DataFrame,
    limits: Limits = Limits(),
    host_col: str = "source",
    text_col: str = "text",
    payload: Sequence[Column] | None = None,
) -> DataFrame:
    """Each row of `docs` as `record`, with host, COUNTS, base_failed, failed, host_rate, verdict, kept.

    Null texts are empty texts. Rows without a host share one. Repeated rows are judged alike and all count for their
    host. A very long text is measured in the memory of its row. No rows: no rows.
    """
    # Written once: hosts are summed over all documents before the first of them can be judged.
    rows = cut_lineage(measure_documents(docs, limits, host_col, text_col, payload))
    verdicts = host_verdicts(rows, limits).select(
        F.col("host").alias("of"), F.col("rate").alias("host_rate"), "verdict"
    )
    any_rule = F.lit(False)
    for name in rows.schema["failed"].dataType.names:
        any_rule = any_rule | F.col(f"failed.{name}")
    kept = ~F.col("base_failed") & (
        (F.col("verdict") == "trusted") | ((F.col("verdict") == "watched") & ~any_rule)
    )
    return (
        rows.join(verdicts, F.col("host").eqNullSafe(F.col("of")), "left").drop("of").withColumn("kept", kept)
    )
