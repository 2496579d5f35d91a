"""Set operations and membership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPREAD = 1 << 16


def union_distinct(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.distinct()


def rows_of(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in `keys`."""
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def rows_of_either(df: DataFrame, on: str, *sources: DataFrame) -> DataFrame:
    """Rows whose key is in any of the one-column sources."""
    keys = union_distinct(*[s.select(F.col(s.columns[0]).alias(on)) for s in sources])
    return df.join(keys, on, "left_semi")


def spread_join(
    left: DataFrame, right: DataFrame, on: list[tuple[str, str]], match: list[Column] | None = None, by: list[str] | None = None
) -> DataFrame:
    """Left join, where left rows without a key, which match nothing, don't all go to the task of the null key.

    `on` pairs left and right columns; the two sides share no column name. Rows
    are spread by `by`: by all columns, all of them are moved, needed or not.
    """
    missing = reduce(Column.__or__, [F.col(name).isNull() for name, _ in on])
    place = F.when(missing, F.pmod(F.xxhash64(*(by or left.columns)), F.lit(_SPREAD)) + 1).otherwise(F.lit(0).cast("long"))
    # Always 0, but no literal: the optimizer would take that out of the join's keys.
    home = F.pmod(F.xxhash64(*[name for _, name in on]), F.lit(1).cast("long"))
    keys = [F.col(a) == F.col(b) for a, b in on]
    return left.join(right, reduce(Column.__and__, [*keys, place == home, *(match or [])]), "left")
