"""Turning a list column into a dimension and a bridge."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import uuid_v5
from tidemark.functions.text import strip_chars
from tidemark.operators.ids import dense_ids


def exploded_items(
    df: DataFrame,
    key: str,
    items: str,
    name: str,
    replacements: list[tuple[str, str]] = (),
    drop_prefixes: list[str] = (),
    drop_values: list[str] = (),
    trim: str = ' ,"',
) -> DataFrame:
    """One row per item of the list, cleaned; empty and unwanted items are left out."""
    cleaned: Column = strip_chars(F.col(name), trim)
    for pattern, replacement in replacements:
        cleaned = F.regexp_replace(cleaned, pattern, replacement)
    rows = df.select(key, F.explode(items).alias(name)).withColumn(name, cleaned)
    rows = rows.filter(F.col(name) != "")
    for prefix in drop_prefixes:
        rows = rows.filter(~F.col(name).startswith(prefix))
    if drop_values:
        rows = rows.filter(~F.col(name).isin(list(drop_values)))
    return rows


def dimension_of(items: DataFrame, name: str, id_column: str, namespace: uuid.UUID | None = None) -> DataFrame:
    """The distinct names, numbered in their order; with a UUID per id if asked for."""
    numbered = dense_ids(items.select(name).distinct(), [name], id_column)
    if namespace is None:
        return numbered.select(id_column, name)
    uuid_column = id_column.removesuffix("_id") + "_uuid"
    return numbered.select(id_column, name, uuid_v5(namespace, id_column).alias(uuid_column))


def bridge_of(items: DataFrame, dimension: DataFrame, key: str, name: str, id_column: str) -> DataFrame:
    """Pairs of owner and dimension id, looked up by name."""
    lookup = dimension.select(name, id_column)
    return items.join(lookup, name).select(key, id_column)
