"""Type 2 history: versions of an entity with validity ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import version_key
from tidemark.operators.latest import tie_breakers

SCD_COLUMNS = ["scd_id", "valid_from", "valid_to", "scd_updated_at"]


def chain_versions(
    versions: DataFrame, keys: list[str], at: str, until: str, ties: list[str] | None = None, distinct: bool = True
) -> DataFrame:
    """Set `until` to the `at` of the next version of the same key.

    With `distinct=False` the last row by the tie columns (all others by
    default) stands for those with equal (keys, at). Rows are shuffled and
    sorted once, by key and day, together with a closing row for each key and
    day: the first time of the key's next day, from the first times of all its
    days. So no task needs more than the versions of one key and day, or one
    narrow row per day of a key. A change feed with a third of its rows in one
    key spreads over as many groups as the key has days; rows without a time
    stay together per key and should be left out before.
    """
    names = [c for c in versions.columns if c != until]
    dated = versions.select(*names, F.to_date(at).alias("_day"), F.lit(0).alias("_closes"))
    firsts = dated.groupBy(*keys, "_day").agg(F.min(at).alias("_first"))
    following = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_day"))
    closing = firsts.select(*keys, "_day", following.alias(at), F.lit(1).alias("_closes")).filter(F.col(at).isNotNull())
    rows = dated.unionByName(closing, allowMissingColumns=True).repartition(*keys, "_day")
    if not distinct:
        ties = ties if ties is not None else [c for c in names if c not in (*keys, at)]
        same = Window.partitionBy(*keys, "_day", "_closes", at).orderBy(at, *[F.col(c).desc_nulls_last() for c in ties])
        rows = rows.withColumn("_rank", F.row_number().over(same)).filter("_rank = 1").drop("_rank")
    in_order = Window.partitionBy(*keys, "_day").orderBy("_closes", at)
    return rows.withColumn(until, F.lead(at).over(in_order)).filter("_closes = 0").select(*names, until)


def build_history(
    changes: DataFrame, keys: list[str], updated_at: str, ties: list[str] | None = None
) -> DataFrame:
    """Full history from a complete feed of changes: one version per change time."""
    dated = changes.filter(F.col(updated_at).isNotNull())
    chained = chain_versions(dated, keys, updated_at, "valid_to", ties, distinct=False)
    return chained.withColumns(_scd(keys, updated_at)).select(*changes.columns, *SCD_COLUMNS)


def _scd(keys: list[str], updated_at: str) -> dict[str, Column]:
    return {
        "scd_id": version_key(keys, updated_at),
        "valid_from": F.col(updated_at),
        "scd_updated_at": F.col(updated_at),
    }


def history_changes(
    history: DataFrame,
    batch: DataFrame,
    keys: list[str],
    updated_at: str,
    ties: list[str] | None = None,
) -> DataFrame:
    """Rows to upsert into `history` by `scd_id` so that it covers `batch`.

    Only rows newer than the open version of their key count. Returned are the
    new versions and the open version they close.
    """
    attributes = [c for c in history.columns if c not in SCD_COLUMNS]
    dated = batch.select(*attributes).filter(F.col(updated_at).isNotNull())
    opened = history.filter(F.col("valid_to").isNull()).select(*attributes)
    newest = opened.select(*keys, F.col(updated_at).alias("_open_at"))
    fresh = (
        dated.join(newest, keys, "left")
        .filter(F.col("_open_at").isNull() | (F.col(updated_at) > F.col("_open_at")))
        .select(*attributes)
    )
    # One narrow row per key tells which versions are closed; equal times are settled as the rows are chained.
    last = dated.groupBy(*keys).agg(F.max(updated_at).alias("_last_at"))
    touched = opened.join(last, keys).filter(F.col("_last_at") > F.col(updated_at)).select(*attributes)
    ties = tie_breakers(dated, {*keys, updated_at}, ties)
    chained = chain_versions(touched.unionByName(fresh), keys, updated_at, "valid_to", ties, distinct=False)
    return chained.withColumns(_scd(keys, updated_at)).select(*history.columns)


def current_rows(history: DataFrame, flag: str = "is_current_record") -> DataFrame:
    """Type 1 view of a type 2 dimension."""
    return history.filter(F.col(flag))
