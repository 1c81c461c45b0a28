"""Column functions; Arrow UDFs only where the algorithm works on bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value written and computed once, though the body repeats it."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)
