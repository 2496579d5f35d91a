"""What large steps move: shuffles that go when a step ends, narrow rows, and each step once."""

import os
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_steps_once import plan_of
from test_tables import SPEC, batch

from tidemark.functions.keys import packed, unpacked
from tidemark.operators import audit
from tidemark.operators.pointintime import BroadcastBound, pit_keys
from tidemark.operators.sets import spread_join
from tidemark.plans import facts, queries
from tidemark.plans.standins import Standins
from tidemark.session import materialise
from tidemark.sources import tables


@pytest.fixture
def folder(spark, tmp_path):
    """Orders 1 to 40 of four customers, two lines each; some lines are delivered twice."""
    day = "timestamp_seconds(800000000 + {} * 86400)"
    spark.range(1, 41).selectExpr(
        "id AS o_orderkey", "id % 4 AS o_custkey", "'O' AS o_orderstatus", "cast(id * 10 AS double) AS o_totalprice",
        f"{day.format('id')} AS o_orderdate", "if(id % 5 = 0, '1-URGENT', '3-MEDIUM') AS o_orderpriority",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.range(1, 41).selectExpr("id", "explode(array(1, 2)) AS n", "explode(if(id % 6 = 0, array(0, 3), array(0))) AS late")
    lines.selectExpr(
        "id AS l_orderkey", "(id + n) % 7 AS l_partkey", "id % 3 AS l_suppkey", "n AS l_linenumber", "cast(n AS double) AS l_quantity",
        "cast(id + n AS double) AS l_extendedprice", "if((id + n) % 4 = 0, 0D, 0.1D) AS l_discount", "0.05D AS l_tax",
        "if(id % 3 = 0, 'R', 'N') AS l_returnflag", "'O' AS l_linestatus", f"{day.format('(id + n + late)')} AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def _shuffle_files(spark):
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(name.startswith("shuffle_") for top in root for _, _, names in os.walk(top.toString()) for name in names)


def test_shuffles_go_when_their_step_ends(spark):
    before = _shuffle_files(spark)
    kept = materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert kept.count() == 7
    assert _shuffle_files(spark) <= before
    # A frame that is read again after its shuffle went gives the same rows.
    again = spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
    assert rows(again) == rows(again) == [(0, 34), (1, 33), (2, 33)]


def test_packed_text_comes_back(spark):
    texts = [None, "", "a", "x" * 14, "x" * 15, "x" * 16, "x" * 17, "0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "g" * 32,
             "é" * 8, "é" * 7 + "a", "a\x01", "a\x02", "b" * 14 + "\x01", "b" * 15 + "\x02", "0" * 32 + "\n", "0" * 33]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed("t").alias("p"))
    assert all(r.t == r.u for r in df.select("t", unpacked("p").alias("u")).collect())
    assert df.select("p").distinct().count() == len(texts)
    assert df.filter(F.col("t") == texts[7]).select(F.octet_length("p")).first()[0] == 16


def test_lookups_move_packed_keys_and_needed_columns_only(spark, no_broadcast):
    at = F.timestamp_seconds(1_000_000_000 + F.col("id"))
    lines = spark.range(60).select(
        "id", (F.col("id") % 4).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("b"), F.md5(F.col("id").cast("string")).alias("text"),
        F.lit("unread").alias("unread"), at.alias("at"))

    def versions(sk):
        return spark.range(3).select(
            F.col("id").alias("k"), F.md5((F.col("id") + 7).cast("string")).alias(sk),
            F.timestamp_seconds(F.lit(1_000_000_010)).alias("valid_from_ts"), F.lit(None).cast("timestamp").alias("valid_to_ts"))

    lookups = [{"versions": versions(f"{c}_sk"), "on": [(c, "k")], "sk": f"{c}_sk"} for c in "ab"]
    keyed = pit_keys(lines, lookups, "at", bound=BroadcastBound(rows=0), by=["id"])
    assert rows(keyed) == rows(pit_keys(lines, lookups, "at"))
    plan = keyed.select("id", "text", "a_sk", "b_sk")._jdf.queryExecution().sparkPlan().toString()
    assert "unread" not in plan.replace("unread:string", ""), plan
    assert "unhex" in plan and "Window" not in plan


def test_spread_by_a_column_gives_the_same_rows(spark):
    left = spark.range(40).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k"))
    right = spark.range(4).select(F.col("id").alias("r"), (F.col("id") * 10).alias("v"))
    assert rows(spread_join(left, right, [("k", "r")], by=["id"])) == rows(spread_join(left, right, [("k", "r")]))


def test_discounts_of_lines_and_orders_share_one_shuffle(spark, folder, no_broadcast):
    prorated = Standins(spark, folder).prorated
    assert prorated.count() == 80
    plan = prorated._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(transaction_line_id#" in plan
    assert not re.search(r"hashpartitioning\(transaction_line_id#\d+L, transaction_id#\d+L", plan), plan


def test_line_and_order_discounts_are_summed_apart(spark):
    discounts = spark.createDataFrame(
        [(1, None, "2.5"), (1, None, "1.5"), (None, 1, "7"), (2, 1, "3"), (None, None, "9"), (3, None, None)],
        "transaction_line_id long, transaction_id long, a string").withColumn("discount_amount", F.col("a").cast("decimal(18,4)"))
    by_line, by_order = facts._discount_totals(discounts)
    assert [(k, float(v)) for k, v in rows(by_line)] == [(1, 4.0), (2, 3.0), (3, 0.0)]
    assert [(k, float(v)) for k, v in rows(by_order)] == [(1, 10.0)]


def test_customer_of_the_own_order_where_that_of_the_line_is_missing(spark):
    discounts = spark.createDataFrame(
        [(1, 10, None), (2, None, 6), (3, 11, 6), (4, 11, None), (5, 10, 6), (6, None, None), (7, 12, 6), (8, 10, 9)],
        "transaction_discount_id long, transaction_line_id long, transaction_id long")
    lines = spark.createDataFrame(
        [(10, 5, 100), (11, 7, 101), (12, 8, 102)], "transaction_line_id long, transaction_id long, product_id long")
    headers = spark.createDataFrame([(5, 50), (6, 60), (8, None)], "transaction_id long, customer_id long")
    want = [(1, 100, 50), (2, None, 60), (3, 101, 60), (4, 101, None), (5, 100, 50), (6, None, None), (7, 102, 60), (8, 100, 50)]
    for reduce in (True, False):
        found = facts.discount_keys(discounts, lines, headers, reduce=reduce)
        assert rows(found, "transaction_discount_id", "product_id", "customer_id") == want


def test_two_paths_find_the_latest_discounts_once(spark, folder, monkeypatch):
    handed = []
    keys = facts.discount_keys
    monkeypatch.setattr(facts, "discount_keys", lambda *args, **named: handed.append(args[0]) or keys(*args, **named))
    found = queries.REGISTRY["two_path_lookup"](spark, folder)
    assert "Window" not in plan_of(handed[0])
    assert found.filter("customer_id IS NOT NULL").count() == found.count() > 0


def test_headers_of_prorated_lines_move_without_unread_columns(spark, folder):
    plan = Standins(spark, folder).prorated._jdf.queryExecution().executedPlan().toString()
    assert "gross_subtotal_amount" not in plan and "employee_id" not in plan, plan
    customers = Standins(spark, folder).order_customers._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in customers and "o_totalprice" not in customers, customers


def test_sales_are_written_once_before_they_are_audited(spark, folder, monkeypatch):
    handed = []
    whole = audit.audit_table
    monkeypatch.setattr(audit, "audit_table", lambda df, *rest: handed.append(df) or whole(df, *rest))
    report = {(r.check_name, r.column_name): r.violations for r in queries.REGISTRY["audit_marts"](spark, folder).collect()}
    assert "Join" not in plan_of(handed[0]) and "Window" not in plan_of(handed[0])
    assert report["unique", "transaction_line_id"] == 0 and len(report) == 5


def test_rows_of_a_write_are_made_once(spark, database):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = batch(spark, *[(k, k % 3, 1, "a") for k in range(30)])
    tables.upsert(df.mapInArrow(count, df.schema), f"{database}.t", SPEC, one_per_key=True)
    assert made.value == 30
    assert tables.read_table(spark, f"{database}.t").count() == 30
