"""Reusable DataFrame operators the plans are made of."""

from reportstar.operators.bridging import resolve_members, with_weights
from reportstar.operators.counting import rows_per_set, summarize_reports_by
from reportstar.operators.numbering import number_rows

__all__ = [
    "number_rows",
    "resolve_members",
    "rows_per_set",
    "summarize_reports_by",
    "with_weights",
]
