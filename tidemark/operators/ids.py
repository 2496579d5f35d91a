"""Dense ids and deterministic samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle


def dense_ids(df: DataFrame, order: list[str], out: str, start: int = 1) -> DataFrame:
    """Number the rows from `start` in the given order; `order` has to be unique.

    Rows are range-partitioned: each partition numbers its own rows and adds the
    sizes of those before it.
    The partitioned rows are checkpointed in between, because sampled range
    bounds need not be the same when a plan is run twice.
    """
    within_task = F.lit((1 << 33) - 1)
    ranged = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(within_task))
    )
    # One row per partition.
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.col("_row") + F.lit(start))
        .select(*df.columns, out)
    )


def continue_ids(new: DataFrame, existing: DataFrame, id_column: str, order: list[str]) -> DataFrame:
    """Number new rows after the greatest id in use (from 1 when there is none)."""
    numbered = dense_ids(new, order, id_column)
    top = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long")).scalar()
    return numbered.withColumn(id_column, F.col(id_column) + top)


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: str = "0") -> DataFrame:
    """At most `n` rows in an order that depends on the seed and the keys only."""
    ticket = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(ticket, *keys).limit(n)
