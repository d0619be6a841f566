"""Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once."""
    return F.transform(F.array(value), lambda x: body(x))[0]
