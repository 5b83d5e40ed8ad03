"""Join and set helpers: natural left join (J4) and fold stacking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on every shared column name (SQL ``NATURAL LEFT JOIN``).

    Equality semantics are SQL's: a NULL in a shared column never matches,
    so such left rows survive with NULL right-only columns.
    """
    shared = [c for c in left.columns if c in set(right.columns)]
    if not shared:
        raise ValueError("natural join needs at least one shared column")
    return left.join(right, shared, "left")


def stack_folds(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
