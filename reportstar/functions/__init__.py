"""Column expressions: text cleaning, date parsing, member sets and group keys."""

from reportstar.functions.clean import (
    blank_to_null,
    clean_text,
    first_non_blank,
    parse_date,
    parse_timestamp,
)
from reportstar.functions.sets import group_key, labels, member_set, target_country_key, tokens

__all__ = [
    "blank_to_null",
    "clean_text",
    "first_non_blank",
    "group_key",
    "labels",
    "member_set",
    "parse_date",
    "parse_timestamp",
    "target_country_key",
    "tokens",
]
