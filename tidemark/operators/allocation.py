"""Spreading order-level amounts over the lines of the order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import MONEY, money, safe_ratio


def total_by(df: DataFrame, keys: list[str], amount: str, out: str) -> DataFrame:
    """Sum of a money column per key; 0 where all amounts are null."""
    return df.groupBy(*keys).agg(F.coalesce(F.sum(money(amount)), F.lit(0)).cast(MONEY).alias(out))


def allocate(
    lines: DataFrame,
    orders: DataFrame,
    keys: list[str],
    weight: Column | str,
    amounts: dict[str, str],
    keep: list[str] | None = None,
) -> DataFrame:
    """Give every line its share `weight / sum(weight)` of its order's amounts.

    `orders` has one row per key. `amounts` maps its amount columns to output
    names, `keep` names columns of it to carry along. Where the weights of an
    order sum to zero the shares are zero. A `weight` that is an expression of
    the lines is not moved with them.

    Lines are summed per order with partial sums, joined with the order amounts
    at order grain, and meet the result in a single join, whose heavy orders
    Spark splits. No task has to hold the lines of an order.
    """
    weight = F.col(weight) if isinstance(weight, str) else weight
    facts = orders.select(*keys, *amounts, *(keep or []))
    sums = lines.groupBy(*keys).agg(F.sum(money(weight)).alias("_weights"))
    joined = lines.join(sums.join(facts, keys, "left"), keys, "left")
    share = safe_ratio(weight, "_weights")
    allocated: dict[str, Column] = {
        out: F.coalesce(money(share * F.coalesce(F.col(name).cast("double"), F.lit(0.0))), F.lit(0).cast(MONEY))
        for name, out in amounts.items()
    }
    return joined.select(
        *lines.columns, *(keep or []), *[column.alias(out) for out, column in allocated.items()]
    )
