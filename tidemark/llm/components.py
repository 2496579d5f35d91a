"""Connected components of a graph that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (`node`, `component`) per node of `edges`; a component is its smallest node.

    Every round hangs the larger neighbours of a node on the smallest one, then
    each node's smaller neighbours on their smallest, so paths halve: rounds grow
    with the logarithm of the longest path. A round is written to the shared
    folder; nothing but two counts comes to the driver. Rows with a null end are
    left out; loops and repeated rows do no harm; no rows give no rows.
    """
    pairs = (
        edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    pairs, before = materialise(pairs, "edges"), None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # A node's larger neighbours hang on the least of its neighbours and itself.
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            down.select("u", F.col("m").alias("v"))
        ).filter("u <> v").distinct()
        pairs = materialise(small, "edges")
        sums = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sums) == before:
            break
        before = tuple(sums)
    tops = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(
        tops.select("node", F.col("node").alias("component"))
    )
