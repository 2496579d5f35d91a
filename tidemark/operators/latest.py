"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def tie_breakers(df: DataFrame, used: set[str], ties: list[str] | None) -> list[str]:
    if ties is not None:
        return ties
    return [f.name for f in df.schema if f.name not in used and not isinstance(f.dataType, _UNORDERED)]


def latest_per_key(
    df: DataFrame, keys: list[str], updated_at: str, ties: list[str] | None = None
) -> DataFrame:
    """Keep the row with the greatest `updated_at` of each key.

    Rows without a change time lose against rows with one. Equal times are
    settled by the tie columns (all other columns by default), so that a re-run
    gives the same row. Spark turns the rank filter into a group limit below
    the shuffle: each task passes on one row per key, so a hot key does not
    collect its rows in one place.
    """
    ties = tie_breakers(df, {*keys, updated_at}, ties)
    order: list[Column] = [F.col(c).desc_nulls_last() for c in [updated_at, *ties]]
    return _first_by(df, keys, order)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Keep the first row of each key in the given order."""
    return _first_by(df, keys, [F.col(c) if isinstance(c, str) else c for c in order])


def _first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
