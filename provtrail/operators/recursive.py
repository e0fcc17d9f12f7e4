"""Recursive queries level by level."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from provtrail.session import materialize


def recurse(seed: DataFrame, step: Callable[[DataFrame], DataFrame], keys: list[str] | None = None) -> DataFrame:
    """UNION ALL of ``seed``, ``step(seed)``, ``step(step(seed))`` ... until a level is empty.

    Unlike a recursive common table expression in SQL this has no limit of levels or rows: each
    level is a written table, and only whether it is empty reaches the driver. With ``keys`` rows
    whose key an earlier level has reached are left out, so cycles end; without them a cycle in
    the data never does.
    """
    level = out = materialize(seed, "recursion")
    while True:
        new = step(level)
        if keys:
            new = new.dropDuplicates(keys).join(out.select(*keys), keys, "left_anti").select(*out.columns)
        level = materialize(new, "recursion")
        if level.isEmpty():
            return out
        out = out.unionByName(level)
