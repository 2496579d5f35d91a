"""One query per operator on the supplied tables, via the stand-ins."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates as D
from tidemark.functions.keys import surrogate_key, uuid_v5
from tidemark.functions.measures import (
    MONEY, discount_amount, discount_level, money, or_unknown, safe_ratio,
)
from tidemark.functions.text import quoted_items
from tidemark.operators import audit
from tidemark.operators.calendar import mean_growth, seasonal_factors
from tidemark.operators.history import build_history, current_rows, history_changes
from tidemark.operators.ids import continue_ids, dense_ids, sample_rows, top_k
from tidemark.operators.incremental import (
    RunWindow, all_rows_of_changed, changed_rows, changed_since,
)
from tidemark.operators.latest import latest_per_key
from tidemark.operators.normalise import bridge_of, dimension_of, exploded_items
from tidemark.operators.pointintime import date_key, pit_join
from tidemark.operators.sets import rows_of, rows_of_either
from tidemark.plans import facts, promotions
from tidemark.plans.audits import audit_sources, source_audits
from tidemark.plans.entities import EVENTS, PREP
from tidemark.plans.proration import Proration
from tidemark.plans.publish import Roles, audit_and_publish, prepare_audit
from tidemark.plans.standins import DISCOUNT_TIES, LINE_TIES, Standins
from tidemark.plans.warehouse import Warehouse
from tidemark.session import configure, fresh_folder, in_parallel, materialise
from tidemark.sources import extract, files, ingest, tables
from tidemark.sources.specs import ENTITY_TABLES, EXTRACTS, LOADS, ExtractSpec, FieldSpec
from tidemark.sources.tables import TableSpec
from tidemark.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_DNS, "tidemark.example")


def query(function: Callable[[Standins], DataFrame]) -> Callable[[Standins], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return tidy(function(Standins(configure(spark), folder)))

    run.__doc__ = function.__doc__
    REGISTRY[function.__name__] = run
    return function


def tidy(df: DataFrame) -> DataFrame:
    """Plain output types: exact sums are done, so money may become double."""
    columns: list[Column] = []
    for f in df.schema:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz").alias(f.name)
        columns.append(column)
    return df.select(*columns)


# Scans, layout, ids ---------------------------------------------------------


def _window(s: Standins, key: str, grain: str) -> DataFrame:
    start, end = D.window_bounds(key, grain)
    return extract.window_extract(
        s.table("lineitem"), "l_shipdate", start, end,
        ["l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"],
    )


@query
def window_extract_day(s: Standins) -> DataFrame:
    return _window(s, "1997-03-05", "daily")


@query
def window_extract_week(s: Standins) -> DataFrame:
    return _window(s, "1997-03-05", "weekly")


@query
def window_extract_month(s: Standins) -> DataFrame:
    return _window(s, "1997-03-05", "monthly")


@query
def window_extract_hour(s: Standins) -> DataFrame:
    start, end = D.window_bounds("2024-01-10-05:00", "hourly")
    return extract.window_extract(s.table("events"), "ts", start, end, ["event_id", "ts", "user_id"])


@query
def partition_bounds(s: Standins) -> DataFrame:
    """Events per run of each grain, with the bounds of the run."""
    events = s.table("events")
    parts = []
    for grain in D.GRAINS:
        start, end = D.key_bounds("ts", grain)
        parts.append(
            events.groupBy(start.alias("start_at"), end.alias("end_at"))
            .agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(grain).alias("grain"), "*")
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def lake_layout_counts(s: Standins) -> DataFrame:
    """Rows per folder of the daily and the weekly layout."""
    lines = s.table("lineitem")
    daily = lines.groupBy(*[c.alias(n) for n, c in D.lake_columns("l_shipdate", "daily").items()])
    weekly = lines.groupBy(*[c.alias(n) for n, c in D.lake_columns("l_shipdate", "weekly").items()])
    count = F.count(F.lit(1)).alias("n_rows")
    none = F.lit(None).cast("int")
    return (
        daily.agg(count).select(F.lit("daily").alias("layout"), "year", "month", "day", none.alias("week"), "n_rows")
        .unionByName(weekly.agg(count).select(
            F.lit("weekly").alias("layout"), "year", none.alias("month"), none.alias("day"), "week", "n_rows"))
    )


@query
def ingest_run(s: Standins) -> DataFrame:
    """Extract two months to the lake, hand over by manifest, load, read the raw table."""
    spark, base = s.spark, fresh_folder(s.spark, "lake")
    spec = ExtractSpec("orders", "o_orderdate", "monthly", "monthly")
    manifest, database = base + "/manifest", _database(spark, "ingest")
    raw = TableSpec("orders", ("o_orderkey",), "o_orderdate", "MONTH", ("o_custkey",))
    for key in ("1996-02-01", "1996-03-01"):
        extract.record_run(spark, manifest, extract.extract_run(s.table("orders"), spec, key, base))
        folder = extract.folder_of_run(spark, manifest, "orders", key)
        tables.append_files(spark, [folder], f"{database}.orders", raw)
    return tables.read_table(spark, f"{database}.orders").select("o_orderkey", "o_custkey", "o_orderdate")


@query
def ingest_backfill(s: Standins) -> DataFrame:
    """One job over a range of days, read back by lake folder."""
    base = fresh_folder(s.spark, "lake")
    lines = s.table("lineitem")
    # The two bounds, as text: dates of the driver's zone would move them.
    first, last = lines.agg(F.min("l_shipdate").cast("string"), F.max("l_shipdate").cast("string")).first()
    low, high = (datetime.fromisoformat((d or "1970-01-01")[:10]) for d in (first, last))
    folder = extract.extract_range(
        lines, ExtractSpec("lineitem", "l_shipdate", "daily", "monthly"), low, high + timedelta(days=1), base,
    )
    lake = s.spark.read.parquet(folder)
    return lake.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(money("l_extendedprice")).alias("amount")
    )


INGEST_KEY = "1997-03-01"


def ingest_sources(s: Standins) -> dict[str, DataFrame]:
    """A change feed for each of the source tables."""
    lines = s.table("lineitem")
    pairs = {f"{n}s_products": lines.select(F.col(c).alias(f"{n}_id"), F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("date_modified"))
             for n, c in (("author", "l_suppkey"), ("publisher", "l_linenumber"), ("promotion_group", "l_suppkey"))}
    monthly = {f"{n}s": s._first_of_period("lineitem", c, "l_shipdate", "MONTH", f"{n}_id")
               for n, c in (("author", "l_suppkey"), ("publisher", "l_linenumber"), ("promotion_group", "l_partkey"))}
    return {
        **pairs, **monthly, "categories": s._first_of_period("lineitem", "l_quantity", "l_shipdate", "MONTH", "category_id"),
        "categories_products": lines.select(F.col("l_quantity").alias("category_id"), F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("date_modified")),
        "suppliers_products": s.raw_supplier_bridge, "customers": s.customer_changes, "products": s.product_changes, "suppliers": s.supplier_changes,
        "promotions": s.promotion_changes, "channels": s.channel_changes, "payment_types": s.payment_type_changes,
        "transaction_headers": s.raw_headers, "transaction_lines": s.raw_lines, "transaction_discounts": s.raw_discounts, "transaction_payments": s.raw_payments,
    }


@query
def ingest_all(s: Standins) -> DataFrame:
    """A run over all ingest specs that dies half way, started again, and once more: rows of each raw table."""
    spark, base, database = s.spark, fresh_folder(s.spark, "lake"), _database(s.spark, "ingest")
    sources = ingest_sources(s)
    extracts = [replace(e, grain="monthly", layout="monthly") for e in EXTRACTS]
    loads = {x.table: (x, TableSpec(x.table, (), x.partition_field, "MONTH", bounds=("date_modified",))) for x in LOADS if x.partition_field == "date_modified"}
    needs = {name: set(ENTITY_TABLES) for name in sources if name not in ENTITY_TABLES}

    def dying(name: str) -> DataFrame:
        if name == "suppliers_products":
            raise RuntimeError("the source is gone")
        return sources[name]

    arguments = (extracts, loads, INGEST_KEY, base, f"{base}/manifest", database, needs)
    try:
        ingest.ingest_run(spark, dying, *arguments)
    except RuntimeError:
        ingest.ingest_run(spark, sources.__getitem__, *arguments)
    counted = ingest.ingest_run(spark, sources.__getitem__, *arguments)
    parts = [
        (tables.read_table(spark, f"{database}.{name}") if n else sources[name].limit(0)).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.max("date_modified").alias("newest"))
        for name, n in sorted(counted.items())
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def conform_schema(s: Standins) -> DataFrame:
    """Explicit schema with required fields and both rounding modes."""
    rows = s.table("lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice").cast("decimal(12,2)")).alias("half_up"),
        (F.col("l_extendedprice").cast("decimal(12,2)")).alias("half_even"),
    )
    return files.conform(rows, (
        FieldSpec("l_orderkey", "bigint", "REQUIRED"), FieldSpec("l_linenumber", "int"),
        FieldSpec("half_up", "decimal(12,1)", rounding="HALF_UP"),
        FieldSpec("half_even", "decimal(12,1)", rounding="HALF_EVEN"),
    ))


@query
def csv_scan(s: Standins) -> DataFrame:
    folder = fresh_folder(s.spark, "csv")
    s.table("part").write.csv(folder, header=True, quote='"', escape='"')
    schema = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    return files.read_csv(s.spark, folder, schema, ["p_partkey", "p_name", "p_size"])


@query
def json_scan(s: Standins) -> DataFrame:
    folder = fresh_folder(s.spark, "json")
    s.table("supplier").select("s_suppkey", "s_name", "s_nationkey").write.json(folder)
    schema = "s_suppkey long, s_name string, s_nationkey int"
    return files.read_json(s.spark, folder, schema, ["s_suppkey", "s_nationkey"])


@query
def topk_parts(s: Standins) -> DataFrame:
    return top_k(
        s.table("part").select("p_partkey", "p_retailprice"), 500,
        [F.col("p_retailprice").desc(), F.col("p_partkey")],
    )


@query
def sample_orders(s: Standins) -> DataFrame:
    """A fixed number of orders placed before noon of a day, chosen by seeded hash."""
    orders = s.table("orders").filter(F.col("o_orderdate") < F.lit("2000-01-01 12:00:00").cast("timestamp"))
    return sample_rows(orders.select("o_orderkey", "o_custkey"), 1000, ["o_orderkey"], "7")


@query
def dense_id(s: Standins) -> DataFrame:
    names = s.table("part").select("p_name", "p_brand").distinct()
    return dense_ids(names, ["p_name", "p_brand"], "name_id")


@query
def continued_ids(s: Standins) -> DataFrame:
    """Number the shipped pairs of part and supplier after the greatest order key."""
    used = s.table("orders").select(F.col("o_orderkey").alias("pair_id"))
    pairs = s.table("lineitem").select("l_partkey", "l_suppkey").distinct()
    return continue_ids(pairs, used, "pair_id", ["l_partkey", "l_suppkey"])


@query
def surrogate_keys(s: Standins) -> DataFrame:
    """Composite key with a null part."""
    pairs = s.table("lineitem").select("l_partkey", "l_suppkey").distinct()
    part = F.when(F.col("l_suppkey") % 7 != 0, F.col("l_suppkey"))
    return pairs.select("l_partkey", "l_suppkey", surrogate_key("l_partkey", part).alias("pair_sk"))


@query
def uuid_v5_keys(s: Standins) -> DataFrame:
    return s.table("customer").select("c_custkey", uuid_v5(NAMESPACE, "c_name").alias("customer_uuid"))


# Latest rows, history, point in time ---------------------------------------


@query
def latest_line(s: Standins) -> DataFrame:
    newest = latest_per_key(s.raw_lines, ["transaction_line_id"], "date_modified", LINE_TIES)
    return newest.select("transaction_line_id", "transaction_id", "product_id", "supplier_id",
                         "quantity", "gross_line_total", "date_modified")


@query
def latest_event_per_user(s: Standins) -> DataFrame:
    events = s.table("events").select("event_id", "user_id", "event_type", "value", "ts")
    return latest_per_key(events, ["user_id"], "ts", ["event_id"])


@query
def customer_history_scd2(s: Standins) -> DataFrame:
    return _customer_history(build_history(s.customer_changes, ["customer_id"], "date_modified", ["order_id"]))


def _customer_history(history: DataFrame) -> DataFrame:
    return history.select("scd_id", "customer_id", "status", "valid_from", "valid_to")


@query
def customer_history_incremental(s: Standins) -> DataFrame:
    """History up to 1998, then the later changes merged into it."""
    changes, cut = s.customer_changes, F.lit("1998-01-01").cast("timestamp")
    history = build_history(
        changes.filter(F.col("date_modified") < cut), ["customer_id"], "date_modified", ["order_id"])
    rows = history_changes(
        history, changes.filter(F.col("date_modified") >= cut), ["customer_id"], "date_modified", ["order_id"])
    return _customer_history(tables.upserted(history, rows, ["scd_id"]))


@query
def customer_current_scd1(s: Standins) -> DataFrame:
    history = build_history(s.customer_changes, ["customer_id"], "date_modified", ["order_id"])
    flagged = history.withColumn("is_current_record", F.col("valid_to").isNull())
    return current_rows(flagged).select("customer_id", "status", "valid_from")


@query
def pit_customer_key(s: Standins) -> DataFrame:
    """Customer version at the shipment of each line delivery; '-1' before the first."""
    lines = s.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    orders = s.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    owned = lines.join(orders, "l_orderkey", "left")
    keyed = pit_join(owned, s.dims("customers")["customers"], [("o_custkey", "customer_id")], "l_shipdate",
                     {"customer_sk": "customer_sk"})
    return keyed.withColumn("customer_sk", or_unknown("customer_sk"))


@query
def pit_customer_key_merge(s: Standins) -> DataFrame:
    """The same lookup through the merge, whatever the number of versions."""
    lines = s.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    orders = s.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    keyed = pit_join(lines.join(orders, "l_orderkey", "left"), s.dims("customers")["customers"], [("o_custkey", "customer_id")],
                     "l_shipdate", {"customer_sk": "customer_sk"}, merge=True)
    return keyed.withColumn("customer_sk", or_unknown("customer_sk"))


@query
def date_key_lookup(s: Standins) -> DataFrame:
    events = s.table("orders").select("o_orderkey", F.col("o_orderdate").alias("at"))
    known = s.dates.filter(~F.col("is_holiday"))
    return date_key(events, known, "at", "order_date_key").select("o_orderkey", "order_date_key")


@query
def removal_resolution(s: Standins) -> DataFrame:
    return s.supplier_bridge


@query
def soft_delete_filter(s: Standins) -> DataFrame:
    """Undeleted pairs and whether they still run."""
    return s.raw_supplier_bridge.filter(F.col("date_deleted").isNull()).select(
        "product_id", "supplier_id", F.col("date_added").alias("added_at"),
        F.col("date_removed").isNull().alias("is_current_record"),
        D.effective_change("date_modified", "date_removed").alias("changed_at"),
    )


@query
def bridge_part_supplier(s: Standins) -> DataFrame:
    dims = s.dims("products", "suppliers")
    return facts.version_bridge(
        s.supplier_bridge, dims["products"], dims["suppliers"], "product", "supplier", "product_supplier_sk")


@query
def bridge_part_supplier_by_start(s: Standins) -> DataFrame:
    dims = s.dims("products", "suppliers")
    return facts.version_bridge(
        s.supplier_bridge, dims["products"], dims["suppliers"], "product", "supplier",
        "product_supplier_sk", by_start=True)


# Joins and sets -------------------------------------------------------------


@query
def semi_join_reduction(s: Standins) -> DataFrame:
    """Lines that have a discount."""
    wanted = s.raw_discounts.filter(F.col("transaction_line_id").isNotNull())
    lines = s.raw_lines.select("transaction_line_id", "product_id", "date_modified", "gross_line_total")
    return rows_of(lines, wanted, ["transaction_line_id"])


@query
def disjunctive_membership(s: Standins) -> DataFrame:
    """Headers named by a discount or by a discounted line."""
    discounts = s.discounts
    lines = rows_of(s.lines, discounts, ["transaction_line_id"])
    return rows_of_either(
        s.headers.select("transaction_id", "customer_id", "transaction_type"), "transaction_id",
        discounts.select("transaction_id"), lines.select("transaction_id"),
    )


@query
def two_path_lookup(s: Standins) -> DataFrame:
    # Read for their own rows and to reduce the lines and headers: written once.
    discounts = materialise(s.discounts.select("transaction_discount_id", "transaction_line_id", "transaction_id"), "latest-discounts")
    keyed = facts.discount_keys(discounts, s.lines, s.order_customers, by=["transaction_discount_id"])
    return keyed.select(
        "transaction_discount_id", "transaction_line_id", "transaction_id", "product_id", "customer_id",
        discount_level().alias("discount_level"),
    )


@query
def affected_key_expansion(s: Standins) -> DataFrame:
    """All lines of the orders with a line changed in a week."""
    lines = s.raw_lines.select("transaction_line_id", "transaction_id", "product_id", "date_modified")
    window = RunWindow("1998-06-01", "1998-06-08")
    return all_rows_of_changed(lines, changed_rows(lines, "date_modified", window, lines), ["transaction_id"])


@query
def union_distinct_eligibility(s: Standins) -> DataFrame:
    """Products in a promotion through their brand or directly."""
    return _eligible(s)


def _eligible(s: Standins) -> DataFrame:
    part = s.table("part")
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    members = part.select(brand.alias("category_id"), F.col("p_partkey").alias("product_id"))
    groups = members.select("category_id").distinct().select(
        "category_id", (F.col("category_id") + 100).alias("promotion_group_id"),
        F.when(F.col("category_id") % 2 == 0, "Category").otherwise("Custom").alias("group_type"),
    )
    direct = part.filter("p_size > 25").select(
        F.col("p_partkey").alias("product_id"),
        (F.when(F.col("p_size") % 2 == 0, brand).otherwise(F.col("p_size")) + 100).alias("promotion_group_id"),
    )
    return promotions.eligible_products(members, groups, direct)


@query
def first_group_of_product(s: Standins) -> DataFrame:
    return promotions.group_of_product(_eligible(s))


# Incremental ----------------------------------------------------------------


@query
def incremental_window(s: Standins) -> DataFrame:
    lines = s.raw_lines.select("transaction_line_id", "product_id", "date_modified")
    return changed_rows(lines, "date_modified", RunWindow("1998-06-01", "1998-06-15"), lines)


@query
def watermark_lookback(s: Standins) -> DataFrame:
    """Lines shipped since three days before the last order."""
    lines = s.raw_lines.select("transaction_line_id", "product_id", "date_modified")
    return changed_rows(lines, "date_modified", RunWindow(), s.table("orders"), "o_orderdate")


@query
def clean_window(s: Standins) -> DataFrame:
    events = s.table("events").select("event_id", "user_id", "ts")
    return changed_since(events, "ts", RunWindow("2024-01-10", "2024-01-12"), events)


@query
def upsert_result(s: Standins) -> DataFrame:
    """Lines up to a day, then everything later with a lookback, upserted by month."""
    spark = s.spark
    table = f"{_database(spark, 'upsert')}.lines"
    spec = TableSpec("lines", ("transaction_line_id",), "date_modified", "MONTH", ("product_id",), "date_modified", ties=tuple(LINE_TIES))
    lines = s.raw_lines.select("transaction_line_id", "transaction_id", "product_id", "supplier_id",
                               "gross_line_total", "date_modified")
    first = lines.filter(F.col("date_modified") < F.lit("1999-01-01").cast("timestamp"))
    tables.upsert(first, table, spec)
    later = changed_rows(lines, "date_modified", RunWindow(), tables.read_table(spark, table), "date_modified")
    tables.upsert(later, table, spec)
    return tables.read_table(spark, table)


# Facts ----------------------------------------------------------------------


@query
def proration(s: Standins) -> DataFrame:
    return s.prorated


@query
def incremental_facts(s: Standins) -> DataFrame:
    """Totals per transaction after a first run, a run with newer rows, and one with header-only and discount-only changes."""
    spark, database = s.spark, _database(s.spark, "incremental")
    table = f"{database}.{{}}_{{}}".format
    work = Proration(spark, *[partial(table, layer) for layer in ("raw", "clean", "prep")], grain="YEAR")
    cut, late = F.lit("1998-01-01").cast("timestamp"), F.lit("2035-01-01").cast("timestamp")
    raw = {
        "transaction_lines": latest_per_key(s.raw_lines, ["transaction_line_id", "date_modified"], "date_modified", LINE_TIES),
        "transaction_headers": s.raw_headers,
        "transaction_discounts": latest_per_key(s.raw_discounts, ["transaction_discount_id", "date_modified"], "date_modified", DISCOUNT_TIES),
    }
    doubled = s.raw_headers.filter("transaction_id % 2 = 0 AND (transaction_id div 2) % 11 = 0").withColumn(
        "total_tax_amount", (F.col("total_tax_amount") * 2).cast(MONEY))
    dearer = latest_per_key(raw["transaction_discounts"], ["transaction_discount_id"], "date_modified", DISCOUNT_TIES).filter(
        "transaction_discount_id % 13 = 0").withColumn("discount_amount", (F.col("discount_amount") + 1).cast(MONEY))
    feeds = [
        {n: df.filter(F.col("date_modified") < cut) for n, df in raw.items()}, {n: df.filter(F.col("date_modified") >= cut) for n, df in raw.items()},
        {n: df.withColumn("date_modified", late) for n, df in (("transaction_headers", doubled), ("transaction_discounts", dearer))},
    ]
    for k, feed in enumerate(feeds):
        for name, rows in feed.items():
            spec = TableSpec(name, (EVENTS[name][0],), "date_modified", "YEAR", bounds=("date_modified",))
            tables.append_rows(rows, table("raw", name), spec, f"feed-{k}")
        work.build(RunWindow())
    totals = facts.signed_totals(tables.read_table(spark, table("prep", PREP.name)))
    return totals.select("transaction_id", "transaction_type", "customer_id", "gross_subtotal_amount", "total_discount_amount", "total_tax_amount", "net_amount")


@query
def line_discount_totals(s: Standins) -> DataFrame:
    by_line = s.discounts.filter(F.col("transaction_line_id").isNotNull())
    return facts.total_by(by_line, ["transaction_line_id"], "discount_amount", "line_discount_amount")


@query
def proration_balance(s: Standins) -> DataFrame:
    """Per transaction: subtotal and what was allocated to its lines."""
    return s.prorated.groupBy("transaction_id").agg(
        F.sum(money(F.col("gross_line_total") - F.col("line_discount_amount"))).cast(MONEY).alias("subtotal"),
        F.sum("prorated_discount_amount").alias("allocated_discount"),
        F.sum("prorated_tax_amount").alias("allocated_tax"),
    )


@query
def sales_fact(s: Standins) -> DataFrame:
    return facts.sales(s.prorated, s.dims("customers", "products", "channels"))


@query
def returns_fact(s: Standins) -> DataFrame:
    return facts.returns(s.prorated, s.dims("customers", "products", "channels"))


@query
def transactions_fact(s: Standins) -> DataFrame:
    return facts.transactions(s.prorated, s.dims("customers", "channels"))


@query
def union_signed(s: Standins) -> DataFrame:
    """Signed totals of purchases and returns per customer."""
    return facts.signed_totals(s.prorated).groupBy("customer_id").agg(
        F.sum("gross_subtotal_amount").alias("gross"), F.sum("net_amount").alias("net"),
        F.count(F.lit(1)).alias("n_transactions"),
    )


@query
def payments_fact(s: Standins) -> DataFrame:
    return facts.payments(s.payments, s.dims("payment_types")["payment_types"])


@query
def discounts_fact(s: Standins) -> DataFrame:
    return facts.discounts(s.discounts, s.lines, s.order_customers, s.dims("promotions", "customers", "products"))


@query
def discount_by_pool(s: Standins) -> DataFrame:
    """Line discount of every pool on the parts shipped."""
    pools = F.array(*[F.lit(p) for p in ("FIXED", "PERCENT", "FLAT", "BOGO", "OTHER")])
    lines = s.raw_lines
    pool = F.element_at(pools, (F.col("supplier_id") % 5 + 1).cast("int"))
    price = money(F.round(F.col("product_id") % 97 + 3, 0))
    value = (F.col("line_number") * 9).cast(MONEY)
    return lines.select("transaction_line_id", "product_id", "supplier_id", "date_modified",
                        discount_amount(pool, price, value, "quantity").alias("discount_amount"))


@query
def order_tax_totals(s: Standins) -> DataFrame:
    lines = s.lines
    on_lines = s.discounts.filter(F.col("transaction_line_id").isNotNull()).select(
        "transaction_line_id", "discount_amount")
    line_discounts = lines.join(on_lines, "transaction_line_id").select("transaction_id", "discount_amount")
    order_discounts = s.headers.filter(F.col("channel_id") <= 2).select(
        "transaction_id",
        F.when(F.col("channel_id") == 1, "FLAT").otherwise("PERCENT").alias("discount_pool"),
        (F.col("customer_id") % 120).cast(MONEY).alias("discount_value"),
    )
    return promotions.order_totals(lines, line_discounts, order_discounts)


@query
def payment_split(s: Standins) -> DataFrame:
    orders = s.table("orders").select(
        "o_orderkey", money("o_totalprice").alias("total_amount"), (F.col("o_orderkey") % 3 + 1).alias("n"))
    return promotions.split_payments(orders, "total_amount", "n").select(
        "o_orderkey", "payment_number", "amount_paid")


@query
def safe_ratios(s: Standins) -> DataFrame:
    """Share of a line in its order; null where the divisor is zero."""
    return s.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
        safe_ratio("l_tax", "l_discount").alias("tax_per_discount"),
    )


# Calendar, normalisation, audits -------------------------------------------


@query
def date_dim(s: Standins) -> DataFrame:
    return s.dates


@query
def seasonality_factor(s: Standins) -> DataFrame:
    """Orders of each day, and what its weekday and ISO week have against the mean of all days."""
    orders = s.table("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n_orders"))
    return seasonal_factors(orders, "day", "n_orders").select("day", "n_orders", F.round("factor", 6).alias("factor"))


@query
def daily_growth(s: Standins) -> DataFrame:
    """Growth a day of what a customer has bought, from the first day to all of it on the last."""
    return mean_growth(s.table("orders"), ["o_custkey"], "o_orderdate", "o_totalprice").select(
        "o_custkey", "days", F.round("growth", 6).alias("growth"))


def _named_items(s: Standins) -> DataFrame:
    text = F.concat(F.lit("['"), F.regexp_replace("p_name", " ", "', '"), F.lit("', 's "), F.col("p_type"), F.lit("', ' ']"))
    parts = s.table("part").select("p_partkey", quoted_items(text).alias("items"))
    return exploded_items(parts, "p_partkey", "items", "word", replacements=[("^hot$", "warm")], drop_prefixes=["s "])


@query
def normalise_list_dimension(s: Standins) -> DataFrame:
    return dimension_of(_named_items(s), "word", "word_id", NAMESPACE)


@query
def normalise_list_bridge(s: Standins) -> DataFrame:
    items = _named_items(s)
    return bridge_of(items, dimension_of(items, "word", "word_id"), "p_partkey", "word", "word_id")


@query
def unique_values(s: Standins) -> DataFrame:
    return s.table("part").select("p_brand").distinct().orderBy("p_brand")


@query
def audit_not_null(s: Standins) -> DataFrame:
    return audit.not_null(s.raw_headers, ["transaction_id", "customer_id", "original_transaction_id"])


@query
def audit_unique(s: Standins) -> DataFrame:
    return audit.unique(s.raw_lines, ["transaction_line_id"])


@query
def audit_relationships(s: Standins) -> DataFrame:
    """Event users that are not customers."""
    return audit.relationship(s.table("events"), "user_id", s.table("customer").filter("c_acctbal > 0"), "c_custkey")


@query
def audit_checks(s: Standins) -> DataFrame:
    """Source constraints of the discounts, one of them broken on purpose."""
    checks = {("check", n): c for n, c in source_audits()["transaction_discounts"].checks.items()}
    checks[("check", "amount_at_least_100")] = F.col("discount_amount") >= 100
    return audit.count_failures(s.raw_discounts, checks)


@query
def audit_marts(s: Standins) -> DataFrame:
    """The full audit of the sales fact against its dimensions; '-1' keys are orphans."""
    from tidemark.plans.audits import MART_AUDITS

    dims = s.dims("customers", "products", "channels")
    parents = {f"dim_{name}_history": dims[name] for name in ("customers", "products", "channels")}
    checks = MART_AUDITS["fct_sales"]
    audited = dict.fromkeys([*checks.not_null, *checks.unique, *[r.column for r in checks.relationships]])
    # Each check reads the fact by itself.
    sold = materialise(facts.sales(s.prorated, dims).select(*audited), "audited-sales")
    return audit.audit_table(sold, checks, parents)


@query
def audit_source_tables(s: Standins) -> DataFrame:
    """Every constraint of the four event tables, over their latest rows; order promotions of group 0 don't exist."""
    parents = {
        "customers": s.table("customer").select(F.col("c_custkey").alias("customer_id")), "channels": s.channel_changes,
        "products": s.product_changes, "promotions": s.promotion_changes, "payment_types": s.payment_type_changes,
    }
    # Each constraint reads its table by itself: the latest rows are written once, as the clean layer has them.
    latest = {
        "transaction_lines": latest_per_key(s.raw_lines, ["transaction_line_id"], "date_modified", LINE_TIES),
        "transaction_discounts": latest_per_key(s.raw_discounts, ["transaction_discount_id"], "date_modified", DISCOUNT_TIES),
    }
    written = in_parallel([partial(materialise, rows, f"latest-{name}") for name, rows in latest.items()])
    events = {
        "transaction_headers": s.raw_headers, "transaction_payments": s.raw_payments, **dict(zip(latest, written, strict=True)),
    }
    return audit_sources({**parents, **events}, events)


@query
def reject_negative_lines(s: Standins) -> DataFrame:
    """Gross per order of lines that fail the job if one is below zero."""
    lines = audit.reject_negative(s.lines, "gross_line_total")
    return lines.groupBy("transaction_id").agg(F.sum("gross_line_total").alias("gross_subtotal"))


# Publishing and streams: state lives in tables of their own ------------------


def _database(spark: SparkSession, purpose: str) -> str:
    name = f"tm_{purpose}_{uuid.uuid4().hex[:12]}"
    tables.create_database(spark, name)
    return name


RETURNS = TableSpec("returns", ("transaction_line_id",), "line_created_at", "MONTH", ("product_id",), "modified_at")
RETURN_COLUMNS = ["transaction_line_id", "transaction_id", "product_id", "net_amount", "line_created_at", "modified_at"]


def _returned(s: Standins) -> DataFrame:
    """Prorated lines of returns, one row a line; written once, as several batches and the sample of a write read them."""
    return materialise(s.prorated.filter(F.col("transaction_type") == "Return").select(*RETURN_COLUMNS), "returned-lines")


@query
def wap_publish(s: Standins) -> DataFrame:
    """Two publish cycles; the view shows the second, built on a clone of the first."""
    spark = s.spark
    blue, green, live = (_database(spark, part) for part in ("blue", "green", "live"))
    rows = _returned(s)
    cut = F.lit("1998-01-01").cast("timestamp")
    audits = {"returns": audit.TableAudit(not_null=("transaction_line_id",), unique=("transaction_line_id",))}
    roles = Roles(live=blue, audit=green)
    for batch in (rows.filter(F.col("modified_at") < cut), rows.filter(F.col("modified_at") >= cut)):
        prepare_audit(spark, roles, {"returns": RETURNS})
        tables.upsert(batch, f"{roles.audit}.returns", RETURNS, one_per_key=True)
        roles = audit_and_publish(spark, roles, live, audits)
    return spark.table(f"{live}.live_returns")


@query
def revert_table(s: Standins) -> DataFrame:
    """Upsert, damage the table, put the earlier version back."""
    spark = s.spark
    table = f"{_database(spark, 'revert')}.returns"
    tables.upsert(_returned(s), table, RETURNS, one_per_key=True)
    before = spark.sql("SELECT current_timestamp() AS t").first().t.astimezone()
    bad = tables.read_table(spark, table).withColumn("net_amount", F.lit(0).cast(MONEY))
    tables.upsert(bad, table, RETURNS, one_per_key=True)
    tables.revert_table(spark, table, RETURNS, before)
    return tables.read_table(spark, table)


@query
def history_publish_after_delete(s: Standins) -> DataFrame:
    """Customer versions published by three runs, the last of which deletes every eleventh customer; who is still current."""
    house = Warehouse(s.spark, f"tm_house_{uuid.uuid4().hex[:12]}")
    house.create()
    feed = latest_per_key(s.customer_changes, ["customer_id", "date_modified"], "date_modified", ["order_id"]).drop("order_id")
    unset = dict.fromkeys(("first_name", "last_name", "email", "gender", "province", "signup_platform"), F.lit(None).cast("string"))
    feed = feed.withColumns({
        "customer_uuid": F.md5(F.col("customer_id").cast("string")), "date_of_birth": F.lit(None).cast("date"),
        "registration_date": F.lit(None).cast("timestamp"), "date_deleted": F.lit(None).cast("timestamp"), **unset,
    })
    # Three loads read it, each of them twice: for the sample of its write and to move it.
    feed = materialise(feed, "customer-feed")
    cut, late = F.lit("1998-01-01").cast("timestamp"), F.lit("2035-01-01").cast("timestamp")
    gone = latest_per_key(feed, ["customer_id"], "date_modified").filter("customer_id % 11 = 0").withColumns(
        {"date_modified": late, "date_deleted": late})
    mart, runs = house.db("mart_blue"), (feed.filter(F.col("date_modified") < cut), feed.filter(F.col("date_modified") >= cut), gone)
    for k, rows in enumerate(runs):
        house.load_raw("customers", rows, f"feed-{k}")
        house.build_clean(RunWindow(), ["customers"])
        house.build_snapshots(["customers"])
        house.build_dimension("customers", RunWindow(), mart)
    current = tables.read_table(s.spark, f"{mart}.dim_customers").select("customer_id", F.lit(True).alias("in_current"))
    history = tables.read_table(s.spark, f"{mart}.dim_customers_history").join(current, "customer_id", "left")
    return history.select(
        "customer_id", F.col("customer_status").alias("status"), "valid_from_ts", "valid_to_ts", "is_current_record", F.coalesce("in_current", F.lit(False)).alias("in_current"))


@query
def expired_partitions(s: Standins) -> DataFrame:
    """Orders by month after dropping the months past their retention."""
    spark = s.spark
    table = f"{_database(spark, 'expire')}.orders"
    spec = TableSpec("orders", ("o_orderkey",), "o_orderdate", "MONTH")
    tables.replace_table(s.table("orders").select("o_orderkey", "o_orderdate"), table, spec)
    tables.expire_partitions(spark, table, spec, 365, date(2000, 7, 1))
    return tables.read_table(spark, table)


def _feed(s: Standins, df: DataFrame, purpose: str, parts: int = 4) -> str:
    """Files of a change feed, older changes in earlier files."""
    folder = fresh_folder(s.spark, purpose)
    at = df.columns[-1]
    df.repartitionByRange(parts, at).write.parquet(folder)
    return folder


@query
def stream_append(s: Standins) -> DataFrame:
    """New files appended once: two rounds over a growing folder."""
    spark, events = s.spark, s.table("events").select("event_id", "user_id", "ts")
    source, out = fresh_folder(spark, "feed"), fresh_folder(spark, "appended")
    checkpoint, cut = fresh_folder(spark, "state"), F.lit("2024-01-15").cast("timestamp")
    for part in (events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut)):
        part.write.mode("append").parquet(source)
        streams.append_stream(streams.new_files(spark, source, events.schema), out, checkpoint)
    return spark.read.parquet(out)


@query
def stream_upsert(s: Standins) -> DataFrame:
    """Latest event per user, kept by micro-batches."""
    spark = s.spark
    events = s.table("events").select("event_id", "user_id", "event_type", "value", "ts")
    table = f"{_database(spark, 'stream')}.users"
    stream = streams.new_files(spark, _feed(s, events, "feed"), events.schema, 1)
    streams.upsert_stream(stream, table, TableSpec("users", ("user_id",), updated_at="ts"), fresh_folder(spark, "state"))
    return tables.read_table(spark, table)


@query
def stream_scd2(s: Standins) -> DataFrame:
    """Customer history, kept by micro-batches of changes in time order."""
    spark, changes = s.spark, s.customer_changes
    table = f"{_database(spark, 'stream')}.customers"
    spec = TableSpec("customers", ("scd_id",), "valid_from", "YEAR", ("customer_id",), fixed_partition=True)
    # Files go in one by one: a version is opened by the first change that arrives for its time.
    folder = fresh_folder(spark, "feed")
    checkpoint = fresh_folder(spark, "state")
    early = F.coalesce(F.col("date_modified") < F.lit("1998-01-01").cast("timestamp"), F.lit(False))
    for part in (changes.filter(early), changes.filter(~early)):
        part.write.mode("append").parquet(folder)
        stream = streams.new_files(spark, folder, changes.schema)
        streams.history_stream(stream, table, spec, ["customer_id"], "date_modified", checkpoint, ["order_id"])
    return _customer_history(tables.read_table(spark, table))


@query
def stream_dedupe(s: Standins) -> DataFrame:
    """Events delivered twice, kept once."""
    spark = s.spark
    events = s.table("events").select("event_id", "user_id", "ts")
    folder, out = fresh_folder(spark, "feed"), fresh_folder(spark, "deduped")
    events.unionByName(events).write.parquet(folder)
    stream = streams.drop_redelivered(streams.new_files(spark, folder, events.schema), ["event_id"], "ts")
    streams.append_stream(stream, out, fresh_folder(spark, "state"))
    return spark.read.parquet(out)


@query
def stream_late_counts(s: Standins) -> DataFrame:
    """Events per type and day, given out once three days have passed after the day."""
    spark = s.spark
    events = s.table("events").select("event_type", "ts").filter(F.col("ts").isNotNull())
    folder, out = fresh_folder(spark, "feed"), fresh_folder(spark, "counts")
    checkpoint, cut = fresh_folder(spark, "state"), F.lit("2024-01-15").cast("timestamp")
    # The second round takes up the counts that the first has left open.
    for part in (events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut)):
        part.write.mode("append").parquet(folder)
        counts = streams.late_tolerant_counts(streams.new_files(spark, folder, events.schema), "ts", "1 day", ["event_type"])
        streams.append_stream(counts, out, checkpoint)
    return spark.read.schema("window_start timestamp, event_type string, rows long").parquet(out)


@query
def stream_enrich(s: Standins) -> DataFrame:
    """Streamed orders with the customer version of their day."""
    spark = s.spark
    orders = s.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = fresh_folder(spark, "enriched")
    stream = streams.new_files(spark, _feed(s, orders, "feed"), orders.schema)
    enriched = streams.enrich_stream(
        stream, s.dims("customers")["customers"], [("o_custkey", "customer_id")], "o_orderdate", {"customer_sk": "customer_sk"})
    streams.append_stream(enriched, out, fresh_folder(spark, "state"))
    return spark.read.parquet(out)
