"""Hot keys: the plans give the rows of brute force."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.allocation import allocate
from tidemark.operators.history import build_history, history_changes
from tidemark.operators.ids import dense_ids
from tidemark.operators.pointintime import BroadcastBound, pit_join, pit_keys
from tidemark.operators.sets import spread_join
from tidemark.plans.facts import discount_keys
from tidemark.plans.standins import Standins
from tidemark.session import materialise


@pytest.fixture
def skewed(spark):
    """Key 0 has a third of all rows, some keys are null, some unmatched."""
    ids = spark.range(600)
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 40)
    return ids.select("id", key.cast("long").alias("k"), (F.col("id") * 7 % 100).alias("v"))


def _versions(spark):
    """Key 0 changes daily; the others a few times."""
    days = spark.range(200).select(F.lit(0).cast("long").alias("k"), F.col("id").alias("d"))
    few = spark.range(40).filter("id > 0").select(
        F.col("id").alias("k"), F.explode(F.array(F.lit(3), F.lit(90)).cast("array<long>")).alias("d"))
    feed = days.unionByName(few).select(
        "k", F.timestamp_seconds(F.lit(1_000_000_000) + F.col("d") * 43_200).alias("changed"), "d")
    return build_history(feed, ["k"], "changed")


@pytest.mark.parametrize("until", [None, "late"])
def test_merge_equals_join(spark, skewed, until):
    facts = skewed.select(
        "id", F.when(F.col("id") % 9 > 0, F.col("k")).cast("int").alias("k"),
        F.when(F.col("id") % 11 > 0, F.timestamp_seconds(F.lit(1_000_000_000 - 50_000) + F.col("v") * 90_000 + F.col("id"))).alias("at"),
    ).withColumn("late", F.timestamp_seconds(F.unix_timestamp("at") + (F.col("id") % 7 - 2) * 40_000))
    # A version that ended without a next one, and one from before 1970.
    versions = _versions(spark).filter("k <> 5 or d <> 90").withColumn(
        "valid_from", F.when((F.col("k") == 7) & (F.col("d") == 3), F.lit("1960-05-05").cast("timestamp")).otherwise(F.col("valid_from")))

    def keyed(merge):
        return rows(pit_join(facts, versions, [("k", "k")], "at", {"scd_id": "sk", "d": "d"}, until,
                             "valid_from", "valid_to", merge=merge))

    plain = keyed(False)
    assert keyed(True) == plain
    assert any(r[-1] is None for r in plain) and any(r[-1] is not None for r in plain)


@pytest.mark.parametrize("bound", [BroadcastBound(), BroadcastBound(rows=10), BroadcastBound(per_key=3)])
def test_pit_join_matches_brute_force(spark, skewed, bound):
    facts = skewed.select("id", "k", F.timestamp_seconds(F.lit(1_000_000_000) + F.col("v") * 90_000).alias("at"))
    versions = _versions(spark)
    held = [(r.k, r.valid_from, r.valid_to, r.scd_id) for r in versions.collect()]
    want = []
    for f in facts.collect():
        found = [v[3] for v in held if v[0] == f.k and v[1] <= f["at"] and (v[2] is None or f["at"] < v[2])]
        assert len(found) <= 1
        want.append((f.id, found[0] if found else None))
    got = pit_join(facts, versions, [("k", "k")], "at", {"scd_id": "sk"}, None, "valid_from", "valid_to", bound)
    assert rows(got, "id", "sk") == sorted(want, key=repr)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (bound == BroadcastBound())
    assert rows(pit_join(facts, versions.limit(0), [("k", "k")], "at", {"scd_id": "sk"}, None, "valid_from", "valid_to", merge=True), "id", "sk") == sorted(
        [(f.id, None) for f in facts.collect()], key=repr)


def test_groups_of_a_merge_are_hours(spark):
    """One key with all facts of 40 hours: no group has more than an hour's."""
    facts = spark.range(4000).select(F.lit(1).cast("long").alias("k"), F.timestamp_seconds(1_000_000_000 + F.col("id") * 36).alias("at"))
    versions = spark.createDataFrame([(1, 999_000_000, None, "a")], "k long, s long, e long, sk string").select(
        "k", F.timestamp_seconds("s").alias("valid_from_ts"), F.timestamp_seconds("e").alias("valid_to_ts"), "sk")
    got = pit_join(facts, versions, [("k", "k")], "at", {"sk": "sk"}, merge=True)
    assert got.filter("sk = 'a'").count() == 4000
    assert re.search(r"hashpartitioning\(_key0#\d+L, _hour#\d+L", got._jdf.queryExecution().executedPlan().toString())


def test_history_of_a_hot_key(spark):
    feed = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 != 1, F.col("id") % 50).alias("k"),
        F.timestamp_seconds(F.lit(1_000_000_000) + F.col("id") % 200 * 20_000).alias("changed"),
        F.col("id").alias("attribute"),
    )
    newest = {}
    for r in feed.collect():
        newest[r.k, r.changed] = max(newest.get((r.k, r.changed), -1), r.attribute)
    want = []
    for (key, at), attribute in newest.items():
        later = [t for k, t in newest if k == key and t > at]
        want.append((key, at, attribute, min(later, default=None)))
    history = build_history(feed, ["k"], "changed")
    assert rows(history, "k", "changed", "attribute", "valid_to") == sorted(want, key=repr)
    keys = [r.scd_id for r in history.filter("k is not null").collect()]
    assert len(keys) == len(set(keys))


def test_incremental_history_of_a_hot_key(spark):
    feed = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 30).alias("k"),
        F.timestamp_seconds(F.lit(1_000_000_000) + F.col("id") * 10_000).alias("changed"),
        F.col("id").alias("attribute"),
    )
    full = build_history(feed, ["k"], "changed")
    first = build_history(feed.filter("attribute < 200"), ["k"], "changed")
    changes = history_changes(first, feed.filter("attribute >= 150"), ["k"], "changed")
    merged = first.join(changes.select("scd_id"), "scd_id", "left_anti").select(*first.columns).unionByName(changes)
    assert rows(merged) == rows(full)


def test_allocation_of_a_hot_order(skewed, spark, no_broadcast):
    lines = skewed.filter("k is not null").select("id", "k", F.col("v").cast("decimal(18,4)").alias("w"))
    orders = spark.range(45).select(F.col("id").alias("k"), (F.col("id") + 100).cast("decimal(18,4)").alias("amount"))
    sums = {}
    for r in lines.collect():
        sums[r.k] = sums.get(r.k, 0) + r.w
    for r in allocate(lines, orders, ["k"], "w", {"amount": "share"}).collect():
        want = float(r.w) / float(sums[r.k]) * (r.k + 100) if sums[r.k] else 0
        assert float(r.share) == pytest.approx(want, abs=0.006)


def test_dense_ids_over_partitions(spark):
    names = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("name"))
    want = [(r.name, n) for n, r in enumerate(sorted(names.collect()), 5)]
    assert rows(dense_ids(names, ["name"], "n", 5)) == want


def test_lookups_by_merge_keep_the_plan_small(spark, skewed):
    facts = skewed.select("id", "k", F.timestamp_seconds(F.lit(1_000_000_000) + F.col("v") * 90_000).alias("at"))
    versions = materialise(
        _versions(spark).withColumnsRenamed({"valid_from": "valid_from_ts", "valid_to": "valid_to_ts"}), "versions")
    lookups = [{"versions": versions.withColumnRenamed("scd_id", sk), "on": [("k", "k")], "sk": sk} for sk in ("sk1", "sk2", "sk3", "sk4", "sk5", "sk6")]
    keyed = pit_keys(facts, lookups, "at", bound=BroadcastBound(rows=0))
    plan = keyed._jdf.queryExecution().sparkPlan().toString()
    # The facts once; for each lookup its versions twice and the keys and times of the facts.
    assert plan.count("FileScan") <= 1 + 6 * 3
    assert rows(keyed) == rows(pit_keys(facts, lookups, "at"))


def _largest_task(df):
    """Share of the rows that the fullest task ends up with."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    df.sparkSession.conf.set(name, "false")
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    df.sparkSession.conf.set(name, "true")
    return max(counts) / sum(counts)


def test_rows_without_a_key_are_spread(spark, no_broadcast):
    left = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 7).alias("k"))
    right = spark.range(5).select(F.col("id").alias("r"), (F.col("id") * 2).alias("v"))
    joined = spread_join(left, right, [("k", "r")])
    want = [(i, i % 7 if i % 10 == 0 else None, i % 7 * 2 if i % 10 == 0 and i % 7 < 5 else None) for i in range(4000)]
    assert rows(joined, "id", "k", "v") == sorted(want, key=repr)
    assert _largest_task(joined) < 0.5


def test_discounts_without_an_order_are_spread(spark, no_broadcast):
    discounts = spark.range(4000).select(
        F.col("id").alias("transaction_discount_id"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("transaction_line_id"),
        F.when(F.col("id") % 10 == 0, F.col("id") % 100).alias("transaction_id"))
    lines = spark.range(4000).select(F.col("id").alias("transaction_line_id"), (F.col("id") % 100).alias("transaction_id"), F.lit(1).alias("product_id"))
    headers = spark.range(100).select(F.col("id").alias("transaction_id"), (F.col("id") + 1000).alias("customer_id"))
    for reduced in (True, False):
        keyed = discount_keys(discounts, lines, headers, reduced)
        assert rows(keyed, "transaction_discount_id", "customer_id") == sorted([(i, i % 100 + 1000) for i in range(4000)], key=repr)
        assert _largest_task(keyed) < 0.5


def test_versions_of_cold_keys_are_joined(spark):
    """Too many versions to broadcast, few of each key: facts and versions move once, and the lookups' order doesn't show."""
    facts = spark.range(900).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id") % 30).cast("int").alias("k"), F.timestamp_seconds(F.lit(1_000_000_000) + F.col("id") * 900).alias("at"))
    versions = build_history(spark.range(90).select(
        (F.col("id") % 30).alias("k"), F.timestamp_seconds(F.lit(1_000_000_000) + F.col("id") * 4000).alias("changed")), ["k"], "changed")
    versions = materialise(versions.withColumnsRenamed({"valid_from": "valid_from_ts", "valid_to": "valid_to_ts"}), "versions")
    lookups = [{"versions": versions.withColumnRenamed("scd_id", "big"), "on": [("k", "k")], "sk": "big"},
               {"versions": versions.filter("k < 9").withColumnRenamed("scd_id", "small"), "on": [("k", "k")], "sk": "small"}]
    keyed = pit_keys(facts, lookups[::-1], "at", bound=BroadcastBound(rows=50))
    assert keyed.columns == ["id", "k", "at", "small", "big"]
    assert "Window" not in keyed._jdf.queryExecution().optimizedPlan().toString()
    assert rows(keyed) == rows(pit_keys(facts, lookups[::-1], "at"))
    backwards = facts.withColumn("until", F.col("at") - F.expr("INTERVAL 1 HOUR"))
    for bound in (BroadcastBound(rows=50), BroadcastBound(rows=50, joined=0)):
        got = pit_join(backwards, versions, [("k", "k")], "at", {"scd_id": "sk"}, "until", bound=bound)
        assert rows(got) == rows(pit_join(backwards, versions, [("k", "k")], "at", {"scd_id": "sk"}, "until"))


def test_prorated_lines_are_shuffled_once(spark):
    """Sums and shares read the deliveries with the same columns, so their shuffles are one."""
    plan = Standins(spark, "/root/testdata/sf0.001").prorated._jdf.queryExecution().sparkPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*l_partkey[^\]]*)\]", plan)
    assert len(scans) == 2
    assert len({re.sub(r"#\d+L?", "", scan) for scan in scans}) == 1


def test_history_changes_read_the_open_versions_twice(spark):
    """Once to tell what is new, once for the versions that close; equal times in a batch are settled by the ties."""
    feed = spark.range(300).select(
        (F.col("id") % 20).alias("k"), F.timestamp_seconds(F.lit(1_000_000_000) + F.floor(F.col("id") / 40) * 10_000).alias("changed"), F.col("id").alias("attribute"))
    full = build_history(feed, ["k"], "changed")
    first = materialise(build_history(feed.filter("attribute < 160"), ["k"], "changed"), "history")
    changes = history_changes(first, materialise(feed.filter("attribute >= 120"), "batch"), ["k"], "changed")
    # Rows are chained twice over: themselves and their days.
    assert changes._jdf.queryExecution().sparkPlan().toString().count("FileScan") <= 2 * 4
    merged = first.join(changes.select("scd_id"), "scd_id", "left_anti").select(*first.columns).unionByName(changes)
    assert rows(merged) == rows(full)


def test_joins_below_a_merge_are_shuffled_once(spark, no_broadcast):
    """The merge reads its facts twice, for rows and for hours; lines and orders below them move once each."""
    folder = "/root/testdata/sf0.001"
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("timestamp").alias("at"))
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("k"))
    versions = spark.range(2000).select(
        F.col("id").alias("k"), F.timestamp_seconds(F.lit(700_000_000)).alias("valid_from_ts"), F.lit(None).cast("timestamp").alias("valid_to_ts"),
        F.md5(F.col("id").cast("string")).alias("sk"))
    got = pit_join(lines.join(orders, "l_orderkey", "left"), versions, [("k", "k")], "at", {"sk": "sk"}, merge=True)
    found = got.collect()
    assert len(found) == lines.count() and all((r.sk is None) == (r.k is None) for r in found)
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"ReusedExchange \[l_orderkey#", plan)) == 2, plan


def test_merge_of_rows_without_time_or_key_and_of_early_times(spark):
    facts = spark.createDataFrame(
        [(1, 1, -5000), (2, 1, None), (3, None, -5000), (4, 1, -10_000_000), (5, 1, 100), (6, 2, 0)], "id int, k int, s long",
    ).select("id", "k", F.timestamp_seconds("s").alias("at"))
    versions = spark.createDataFrame([(1, -9000, -4000, "a"), (1, -4000, None, "b")], "k long, s long, e long, sk string").select(
        "k", F.timestamp_seconds("s").alias("valid_from_ts"), F.timestamp_seconds("e").alias("valid_to_ts"), "sk")
    got = pit_join(facts, versions, [("k", "k")], "at", {"sk": "sk"}, merge=True)
    assert got.columns == ["id", "k", "at", "sk"] and dict(got.dtypes)["k"] == "int"
    assert rows(got, "id", "sk") == [(1, "a"), (2, None), (3, None), (4, None), (5, "b"), (6, None)]
