"""Naming an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    Without it, every use would repeat the whole expression: nested uses multiply.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
