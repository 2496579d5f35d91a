"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import n_words_column
from tidemark.session import materialise

HEX_DIGITS = 3  # a source is cut into 16^3 buckets by the start of its rows' keys


def running_totals(df: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """`df` with, per name, the sum over all rows before this one, and `position` from 0.

    Rows are ranged over tasks, summed within each range, and the ranges' totals
    (one row a task) carried over, so no task sees the whole table. `order` must
    tell all rows apart. An empty table gives an empty table.
    """
    sums = sums | {"position": F.lit(1)}
    ranged = materialise(
        df.select("*", *[f.alias(f"_v_{n}") for n, f in sums.items()]).repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id()), "ranged",
    )
    before = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    starts = totals.select("_range", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_s_{n}") for n in sums])
    return ranged.join(F.broadcast(starts), "_range").select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.coalesce(F.sum(f"_v_{n}").over(before), F.lit(0)) + F.col(f"_s_{n}")).alias(n) for n in sums],
    )


def source_targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Targets of `sources` (source, source_size), one row each.

    Sources by code point, null last, weigh `weights` in turn and share the sum
    of all sizes. A source gets `most` times its size at most. What is over goes
    to the others by weight until none is above: a level L with targets
    least(most * size, weight * L). Sources by rising size for their weight fill
    up first, so the level follows from the sums before each.
    """
    ranked = running_totals(sources, [F.col("source").isNull(), F.col("source")], {})
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    weighed = ranked.withColumn("weight", turn).drop("position")
    most_words = (F.lit(most) * F.col("source_size")).cast("double")
    order = [F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source")]
    filled = running_totals(weighed, order, {"full": F.lit(most) * F.col("source_size"), "heavy": F.col("weight")})
    total = F.broadcast(sources.agg(F.sum("source_size").alias("total")))
    weight = F.broadcast(weighed.agg(F.sum("weight").alias("all_weight")))
    share = (F.col("total") - F.col("full")).cast("double") * F.col("weight") / (F.col("all_weight") - F.col("heavy"))
    # Two tables of one row each: their product adds two columns.
    held = filled.join(total, F.lit(True)).join(weight, F.lit(True)).withColumn("held", most_words <= share)
    held = materialise(held, "held")
    capped = F.broadcast(held.filter("held").agg(
        F.coalesce(F.sum(F.lit(most) * F.col("source_size")), F.lit(0)).alias("spent"),
        F.coalesce(F.sum("weight"), F.lit(0)).alias("done"),
    ))
    level = (F.col("total") - F.col("spent")).cast("double") * F.col("weight") / (F.col("all_weight") - F.col("done"))
    return held.join(capped, F.lit(True)).select(
        "source", "source_size", "weight", F.when(F.col("held"), most_words).otherwise(level).alias("target")
    )


def mixture(
    docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, seed: str = "mix", size: Column | None = None
) -> DataFrame:
    """`docs` with size, source_size, target and copies: how often the mix takes each row.

    `size` is the number of words unless given. Every row is taken
    target / source_size times: that many whole times, and once more if it comes
    early enough in its source's seeded order (by md5 of seed and doc_id) to make
    up the fraction, to within half a row. So a row is taken `most` times at
    most, and a rerun takes the same. Only sums per source and bucket move, and
    the rows of the one bucket per source in which the fraction ends.

    A null text has size 0; a null source is a source. Rows that share a doc_id
    (also null) are taken together. Sources without words have target 0 and no
    copies. Added columns replace columns of these names.
    """
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("`doc_id`").cast("string"), F.lit("null"))).cast("binary"))
    sized = docs.withColumn("size", n_words_column(F.col("`text`")) if size is None else size).withColumn("_key", key)
    thin = materialise(sized.select("source", "size", "_key"), "sizes")
    bucket = F.substring("_key", 1, HEX_DIGITS).alias("bucket")
    buckets = materialise(thin.groupBy("source", bucket).agg(F.sum("size").alias("words")), "buckets")
    targets = source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = materialise(
        targets.withColumn("whole", whole.cast("long")).withColumn("more", F.col("target") - F.col("whole") * F.col("source_size")), "targets"
    )
    by_source = Window.partitionBy("source")
    before = F.coalesce(F.sum("words").over(by_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = targets.select(F.col("source").alias("_s"), "more")
    ends = (
        buckets.withColumn("before", before).join(at, F.col("source").eqNullSafe(F.col("_s")))
        .filter((F.col("more") > F.col("before")) & (F.col("more") <= F.col("before") + F.col("words")))
        .select("source", "bucket", "before", "more")
    )
    ends = materialise(ends, "ends")
    place = ends.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), "before", "more")
    rows = thin.withColumn("bucket", bucket).join(
        place, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b"))
    ).groupBy("source", "bucket", "_key").agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("more").alias("more"))
    inside = F.coalesce(F.sum("words").over(by_source.orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = (
        rows.withColumn("inside", inside)
        .filter(2 * (F.col("before") + F.col("inside")) + F.col("words") <= 2 * F.col("more"))
        .groupBy("source").agg(F.max("_key").alias("last"))
    )
    cuts = ends.join(last.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_s"), F.coalesce("last", "bucket").alias("_cut")
    )
    plan = materialise(
        targets.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left")
        .select(F.col("source").alias("_s"), "source_size", "target", F.col("whole").alias("_whole"), "_cut"), "mixture",
    )
    more = F.coalesce((F.col("_key") <= F.col("_cut")).cast("long"), F.lit(0))
    return sized.drop("source_size", "target", "copies").join(plan, F.col("`source`").eqNullSafe(F.col("_s")), "left").select(
        *[F.col(f"`{c}`") for c in names], "size", "source_size", "target", (F.col("_whole") + more).alias("copies")
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """`docs`, each row as often as the mix takes it; columns as they came."""
    thin = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    counted = mixture(thin.select("row", "row.doc_id", "row.text", "row.source"), **settings)
    return counted.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
