"""Joins of events to the version of an entity that was valid at the time."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import packed, unpacked
from tidemark.functions.measures import or_unknown
from tidemark.operators.sets import spread_join
from tidemark.session import in_parallel, materialise

OPEN_END = "9999-12-31 00:00:00"


def open_end(valid_to: Column) -> Column:
    return F.coalesce(valid_to, F.lit(OPEN_END).cast("timestamp"))


BROADCAST, JOIN, MERGE = "broadcast", "join", "merge"


@dataclass(frozen=True)
class BroadcastBound:
    """What a version table must not exceed to be broadcast: all its rows, and those of one key, which each fact is held against.

    `joined` is the most versions of one key for a plain shuffled join, which
    moves facts and versions once each; beyond it they are merged.
    """

    rows: int = 500_000
    per_key: int = 1_000
    joined: int = 64

    @classmethod
    def of(cls, spark: SparkSession) -> BroadcastBound:
        return cls(int(spark.conf.get("spark.tidemark.broadcast.rows", str(cls.rows))),
                   int(spark.conf.get("spark.tidemark.broadcast.perKey", str(cls.per_key))),
                   int(spark.conf.get("spark.tidemark.join.perKey", str(cls.joined))))

    def way(self, versions: DataFrame, keys: list[str]) -> str:
        """How to look versions up. Counted, not estimated."""
        counts = versions.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("rows"), F.max("n").alias("most"))
        found = counts.first()
        if not found.rows or (found.rows <= self.rows and found.most <= self.per_key):
            return BROADCAST
        return JOIN if found.most <= self.joined else MERGE


def pit_join(
    facts: DataFrame,
    versions: DataFrame,
    on: list[tuple[str, str]],
    at: str,
    take: dict[str, str],
    until: str | None = None,
    valid_from: str = "valid_from_ts",
    valid_to: str = "valid_to_ts",
    bound: BroadcastBound | None = None,
    counted: DataFrame | None = None,
    merge: bool | None = None,
    way: str | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Left join on `at >= valid_from and until < valid_to`.

    `on` pairs fact and version columns, `take` maps version columns to output
    names, `until` defaults to `at`. The versions of a key must not overlap. A
    version table within `bound` is broadcast, so that a dimension of a few rows
    doesn't shuffle the facts; one with few versions of each key is joined, any
    other goes through `asof_merge`. `merge` (or else broadcast) or `way` decide
    without counting. `counted` stands in for the facts where only their
    keys and times are read: in a chain of lookups the facts as they were before
    it, which keeps the plan from doubling each time. `by` names columns that
    tell the facts apart, to spread those without a key by.
    """
    keys = [f"_key{i}" for i in range(len(on))]
    right = versions.select(
        *[F.col(dim).alias(key) for key, (_, dim) in zip(keys, on, strict=True)],
        F.col(valid_from).cast("timestamp").alias("_from"),
        open_end(F.col(valid_to)).alias("_to"),
        *[F.col(name).alias(out) for name, out in take.items()],
    )
    until = until or at
    if way is None and merge is not None:
        way = MERGE if merge else BROADCAST
    if way is None:
        way = (bound or BroadcastBound.of(facts.sparkSession)).way(right, keys)
    if way == JOIN and not facts.isStreaming:
        match = [F.col(at) >= F.col("_from"), F.col(until) < F.col("_to")]
        return spread_join(facts, right, list(zip([fact for fact, _ in on], keys, strict=True)), match, by).select(
            *facts.columns, *take.values())
    if way == MERGE:
        return _merged(facts, counted or facts, right, [fact for fact, _ in on], keys, at, until, list(take.values()))
    return _joined(facts, F.broadcast(right) if not facts.isStreaming else right, [fact for fact, _ in on], keys, at, until, list(take.values()))


def _joined(
    facts: DataFrame, right: DataFrame, fact_keys: list[str], keys: list[str], at: str, until: str, taken: list[str]
) -> DataFrame:
    match = [F.col(fact) == F.col(key) for key, fact in zip(keys, fact_keys, strict=True)]
    match += [F.col(at) >= F.col("_from"), F.col(until) < F.col("_to")]
    return facts.join(right, reduce(Column.__and__, match), "left").select(*facts.columns, *taken)


def _merged(
    facts: DataFrame, counted: DataFrame, right: DataFrame, fact_keys: list[str], keys: list[str], at: str, until: str, taken: list[str]
) -> DataFrame:
    if until == at:
        return asof_merge(facts, counted, right, fact_keys, keys, at, until, taken)
    # A relation that ended before it began can fit several versions, not only the last one begun.
    backwards = F.coalesce(F.col(until) < F.col(at), F.lit(False))
    forwards = asof_merge(facts.filter(~backwards), counted, right, fact_keys, keys, at, until, taken)
    return forwards.unionByName(_joined(facts.filter(backwards), right, fact_keys, keys, at, until, taken))


def asof_merge(
    facts: DataFrame, counted: DataFrame, right: DataFrame, fact_keys: list[str], keys: list[str], at: str, until: str, taken: list[str]
) -> DataFrame:
    """Each fact with the last version of its key begun by `at`, if `until` is before that one's end.

    Facts and versions go into one table, shuffled and sorted once by key, hour
    and time, and each fact takes the last version before it in its group. What
    an hour begins with is carried into it by an opening row, made from one
    narrow row per key and hour. So a group holds the facts of one key in one
    hour, however hot the key, and a key's list of hours is bounded by the
    calendar. Facts without a key or time match nothing and are spread.
    """
    version = F.struct(F.col("_to"), *[F.col(c) for c in taken])
    kinds = {k: _common_type(facts, f, right, k) for k, f in zip(keys, fact_keys, strict=True)}
    hour = F.floor(F.unix_micros("_at") / F.lit(3_600_000_000)).cast("long")
    own = [F.col(f).cast(kinds[k]).alias(k) for k, f in zip(keys, fact_keys, strict=True)]
    known = reduce(Column.__and__, [F.col(f).isNotNull() for f in (*fact_keys, at)])
    spread = -1 - F.pmod(F.xxhash64(*facts.columns), F.lit(1 << 20))

    # The row moves without the key and time columns that move beside it anyway.
    beside = {f: k for k, f in zip(keys, fact_keys, strict=True) if facts.schema[f].dataType.simpleString() == kinds[k]}
    if facts.schema[at].dataType.typeName() == "timestamp":
        beside[at] = "_at"
    rows = facts.select(
        *own, F.col(at).cast("timestamp").alias("_at"), F.lit(1).cast("tinyint").alias("_kind"), known.alias("_known"),
        F.struct(F.lit(None).cast("boolean").alias("_any"), *[F.col(c) for c in facts.columns if c not in beside]).alias("_row"), spread.alias("_spread"),
    )
    # Before 1970 hours are negative too, but a row spread there lacks a key, or its missing time sorts before all versions.
    rows = rows.withColumn("_hour", F.when(F.col("_known"), hour).otherwise(F.col("_spread"))).drop("_known", "_spread")
    begun = right.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in (*keys, "_from")])).select(
        *[F.col(k).cast(kinds[k]).alias(k) for k in keys], F.col("_from").alias("_at"), F.lit(0).cast("tinyint").alias("_kind"), version.alias("_version"),
    ).withColumn("_hour", hour)

    if counted is facts:
        # Always 0 where known, but as one expression over all columns: both reads of the facts keep the same plan, and
        # Spark shuffles for the joins below them once. Facts given as a table to count are read by key and time alone.
        known = F.when(known, F.pmod(F.xxhash64(*facts.columns), F.lit(1).cast("long"))) == 0
    asked = counted.filter(known).select(*own, F.col(at).cast("timestamp").alias("_at")).select(*keys, hour.alias("_hour")).distinct()
    last = begun.groupBy(*keys, "_hour").agg(F.max_by("_version", "_at").alias("_last"))
    hours = asked.withColumn("_asked", F.lit(True)).unionByName(last, allowMissingColumns=True)
    # Of one hour the question comes first: it is for what the hour begins with.
    before = Window.partitionBy(*keys).orderBy("_hour", F.col("_asked").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opening = hours.withColumn("_version", F.last("_last", ignorenulls=True).over(before)).filter(
        F.col("_asked") & F.col("_version").isNotNull()).select(
        *keys, F.timestamp_micros(F.col("_hour") * F.lit(3_600_000_000)).alias("_at"), F.lit(-1).cast("tinyint").alias("_kind"), "_hour", "_version")

    names = [*keys, "_hour", "_at", "_kind", "_row", "_version"]
    table = rows.unionByName(begun, allowMissingColumns=True).unionByName(opening, allowMissingColumns=True).select(*names)
    upto = Window.partitionBy(*keys, "_hour").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = table.withColumn("_found", F.last("_version", ignorenulls=True).over(upto)).filter("_kind = 1").select(
        *[F.col(beside.get(c, f"_row.`{c}`")).alias(c) for c in facts.columns], "_found")
    fits = F.col(until) < F.col("_found._to")
    return found.select(*facts.columns, *[F.when(fits, F.col(f"_found.{c}")).alias(c) for c in taken])


def _common_type(facts: DataFrame, fact: str, right: DataFrame, key: str) -> str:
    kinds = {facts.schema[fact].dataType.simpleString(), right.schema[key].dataType.simpleString()}
    if len(kinds) == 1:
        return kinds.pop()
    if kinds <= {"tinyint", "smallint", "int", "bigint"}:
        return "bigint"
    raise TypeError(f"{fact} and its version key differ in type: {sorted(kinds)}")


def pit_keys(
    facts: DataFrame, lookups: list[dict], at: str, unknown: bool = True, bound: BroadcastBound | None = None, by: list[str] | None = None
) -> DataFrame:
    """Several point-in-time lookups one after another, each adding one key.

    Unless all are broadcast, the facts are written once before: each merge also
    reads their keys and times, and what was shuffled to make them is gone
    before they are shuffled for the lookups. Texts move packed.
    """
    bound = bound or BroadcastBound.of(facts.sparkSession)
    tables = [lookup["versions"].select(*[dim for _, dim in lookup["on"]]) for lookup in lookups]
    ways = in_parallel([partial(bound.way, t, t.columns) for t in tables])
    names = [*facts.columns, *[lookup["sk"] for lookup in lookups]]
    moved = [(lookup, way) for lookup, way in zip(lookups, ways, strict=True) if way != BROADCAST]
    texts = []
    if moved:
        keys = {fact for lookup, _ in moved for fact, _ in lookup["on"]}
        texts = [f.name for f in facts.schema if f.dataType == T.StringType() and f.name not in keys]
        facts = materialise(facts, "facts").withColumns({c: packed(c) for c in texts})
    counted = facts
    # Broadcast lookups last: their keys need not go through the shuffles of the others.
    for lookup, way in sorted(zip(lookups, ways, strict=True), key=lambda pair: pair[1] == BROADCAST):
        sk, versions = lookup["sk"], lookup["versions"]
        if way != BROADCAST and versions.schema[sk].dataType == T.StringType():
            versions, texts = versions.withColumn(sk, packed(sk)), [*texts, sk]
        facts = pit_join(facts, versions, lookup["on"], lookup.get("at", at), {sk: sk}, counted=counted, way=way, by=by)
    facts = facts.withColumns({c: unpacked(c) for c in texts})
    if unknown:
        facts = facts.withColumns({lookup["sk"]: or_unknown(lookup["sk"]) for lookup in lookups})
    return facts.select(*names)


def date_key(facts: DataFrame, dates: DataFrame, at: str, out: str) -> DataFrame:
    """Key of the day of `at` as text; '-1' for a day outside the date dimension."""
    lookup = dates.select(F.col("full_date").alias("_date"), F.col("date_key").alias("_date_key"))
    joined = facts.join(lookup, F.to_date(at) == F.col("_date"), "left")
    return joined.select(*facts.columns, or_unknown("_date_key").alias(out))
