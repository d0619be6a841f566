"""Delimited lists as member sets, and the hash that names a set."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The member that stands for an empty set, the text hashed for an adversary
# without target countries (another spelling, a separate key space), and the separators.
UNKNOWN = "UNKNOWN"
NO_TARGET = "Unknown"
COMMA = ","
PIPE = r"\|"


def _pieces(c: Column, separator: str) -> Column:
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), separator), lambda part: F.trim(part))
    return F.array_remove(parts, "")


def tokens(c: Column, separator: str) -> Column:
    """Upper-case trimmed members in list order, blanks dropped, repeats kept."""
    return _pieces(F.upper(c), separator)


def labels(c: Column, separator: str) -> Column:
    """Trimmed distinct members in their own spelling."""
    return F.array_distinct(_pieces(c, separator))


def member_set(members: Column) -> Column:
    """Sorted distinct members; an empty or NULL list becomes the unknown member."""
    return F.when(F.size(members) > 0, F.sort_array(F.array_distinct(members))).otherwise(
        F.array(F.lit(UNKNOWN))
    )


def group_key(members: Column) -> Column:
    """md5 over the joined set: equal sets share one key, whatever the source order."""
    return F.md5(F.array_join(members, "|"))


def packed_key(key: Column) -> Column:
    """The 16 bytes of a group key, for a shuffle: half of its text, which is hex that shuffle codecs cannot shorten."""
    return F.unhex(key)


def unpacked_key(packed: Column) -> Column:
    """The group key of 16 bytes."""
    return F.lower(F.hex(packed))


def key_bytes(key: Column) -> Column:
    """A key to deal and compare rows by, in half the bytes: 16 for a group key. Any other text stays different from all
    keys and from other texts, being longer."""
    is_key = (F.length(key) == 32) & (unpacked_key(packed_key(key)) == key)
    return F.when(is_key, packed_key(key)).otherwise(F.concat(F.encode(key, "UTF-8"), F.lit(bytes(17))))


def target_country_key(raw_list: Column, members: Column) -> Column:
    """Key of an adversary's target list. Only a NULL or empty text counts as "no target",
    and repeated members stay in the hash."""
    return F.when(F.coalesce(raw_list, F.lit("")) == "", F.md5(F.lit(NO_TARGET))).otherwise(
        group_key(F.sort_array(members))
    )
