"""Texts of reports, stored once for each distinct set of them.

Copying texts from layer to layer costs a multiple of the feed. Layers carry a key of the content instead, and the texts
meet it where somebody reads them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXTS = ("description", "actions", "analysis")
TEXT_KEY = "text_key"


def digest(text: str) -> Column:
    return F.sha2(F.col(text), 256)


def text_key(of: Callable[[str], Column] = digest) -> Column:
    """16 bytes of a SHA-256 over the digests of the texts, as many as a group key has; NULL if a report has none.
    `of`: the digest of a text by its column, for whoever has made it before."""
    digests = [of(c) for c in TEXTS]
    named = F.concat(*(F.coalesce(d, F.lit("-")) for d in digests))
    return F.when(F.coalesce(*digests).isNotNull(), F.unhex(F.substring(F.sha2(named, 256), 1, 32)))


def with_key(reports: DataFrame) -> DataFrame:
    """Reports with their key; a feed whose texts are stored apart has it already."""
    return reports if TEXT_KEY in reports.columns else reports.withColumn(TEXT_KEY, text_key())


def apart(reports: DataFrame) -> DataFrame:
    """The key in place of the texts; a feed that comes without them is left as it is."""
    if TEXTS[0] not in reports.columns:
        return reports
    keyed = with_key(reports)
    place = keyed.columns.index(TEXTS[0])
    others = [c for c in keyed.columns if c not in (TEXT_KEY, *TEXTS)]
    return keyed.select(*others[:place], TEXT_KEY, *others[place:])


def apart_of(rest: DataFrame, own: DataFrame) -> DataFrame:
    """The same of a feed in two parts: only keys of texts travel to their reports. The second part may be these already."""
    name, *others = rest.columns
    place = others.index("title") + 1
    keys = with_key(own).select(name, TEXT_KEY)
    return rest.join(keys, name, "left").select(*others[:place], TEXT_KEY, *others[place:])


def held(reports: DataFrame) -> tuple[str, ...]:
    """The columns that stand for the texts: themselves, or their key where they are stored apart."""
    return TEXTS if TEXTS[0] in reports.columns else (TEXT_KEY,)


def distinct_texts(reports: DataFrame) -> DataFrame:
    """(text_key, texts), each key once. Equal rows are merged map-side by hashing, without a sort."""
    return with_key(reports).select(TEXT_KEY, *TEXTS).filter(F.col(TEXT_KEY).isNotNull()).distinct()


def with_texts(reports: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts beside their key, lazily. A key has one row; the grouping says so to Spark, which then leaves the join out
    wherever no text is read."""
    unique = texts.groupBy(TEXT_KEY).agg(*(F.first(c).alias(c) for c in TEXTS))
    joined = reports.join(unique, TEXT_KEY, "left")
    place = reports.columns.index(TEXT_KEY)
    return joined.select(*reports.columns[: place + 1], *TEXTS, *reports.columns[place + 1 :])
