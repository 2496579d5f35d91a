"""Retail source tables derived from the supplied order tables.

Every order gives a purchase header and a return header; a line belongs to the
return if its flag says so. Repeated line numbers are re-deliveries of a line.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.measures import money
from tidemark.operators.calendar import date_dimension
from tidemark.operators.history import build_history
from tidemark.plans import facts
from tidemark.plans.entities import stage_bridge, stage_event
from tidemark.session import in_parallel, materialise

LINE_TIES = ["product_id", "supplier_id"]
DISCOUNT_TIES = ["promotion_id", "discount_amount"]
# Proration reads the latest lines twice, for sums and shares. Ties on all it takes keep
# both reads to the same columns, so that Spark shuffles the deliveries once for both.
# Of a header the other columns follow from its id and these. Its tax follows its total, and goes up with it.
HEADER_TIES = ["channel_id", "customer_id", "total_tax_amount"]
PRORATED_TIES = [*LINE_TIES, "transaction_id", "line_number", "quantity", "gross_line_total", "transaction_date"]


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A supplied table; times without zone are read as UTC."""
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    naive = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive})


@dataclass(frozen=True)
class Standins:
    spark: SparkSession
    folder: str
    _read: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        """A supplied table; its files are looked at once."""
        if name not in self._read:
            self._read[name] = load(self.spark, self.folder, name)
        return self._read[name]

    @property
    def raw_lines(self) -> DataFrame:
        returned = (F.col("l_returnflag") == "R").cast("long")
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_line_id"),
            (F.col("l_orderkey") * 2 + returned).alias("transaction_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            money(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            money("l_extendedprice").alias("gross_line_total"),
            F.col("l_shipdate").alias("transaction_date"),
            F.col("l_shipdate").alias("date_modified"),
        )

    @property
    def raw_headers(self) -> DataFrame:
        orders = self.table("orders").withColumn("_kind", F.explode(F.array(F.lit(0), F.lit(1))))
        total = money("o_totalprice")
        tax = money(total * F.lit("0.08").cast("decimal(4,2)"))
        purchase = F.col("o_orderkey") * 2
        return orders.select(
            (purchase + F.col("_kind")).alias("transaction_id"),
            F.md5((purchase + F.col("_kind")).cast("string")).alias("transaction_uuid"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("channel_id"),
            F.lit(None).cast("long").alias("employee_id"),
            F.col("o_custkey").alias("customer_id"),
            total.alias("gross_subtotal_amount"),
            tax.alias("total_tax_amount"),
            money(total + tax).alias("total_amount"),
            F.when(F.col("_kind") == 0, "Purchase").otherwise("Return").alias("transaction_type"),
            F.when(F.col("_kind") == 1, purchase).alias("original_transaction_id"),
            F.col("o_orderdate").alias("transaction_date"),
            F.col("o_orderdate").alias("date_modified"),
        )

    @property
    def raw_discounts(self) -> DataFrame:
        rate = F.col("l_discount").cast("decimal(6,2)")
        on_lines = self.table("lineitem").filter("l_discount > 0").select(
            ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 2).alias("transaction_discount_id"),
            F.col("l_suppkey").alias("promotion_id"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_line_id"),
            F.lit(None).cast("long").alias("transaction_id"),
            F.col("l_quantity").cast("int").alias("discounted_units"),
            money(money("l_extendedprice") * rate).alias("discount_amount"),
            F.lit(1).alias("discount_sequence"),
            F.col("l_shipdate").alias("date_applied"),
            F.col("l_shipdate").alias("date_modified"),
        )
        on_orders = self.table("orders").filter("o_orderpriority = '1-URGENT'").select(
            (F.col("o_orderkey") * 2 + 1).alias("transaction_discount_id"),
            (F.col("o_custkey") % 10).alias("promotion_id"),
            F.lit(None).cast("long").alias("transaction_line_id"),
            (F.col("o_orderkey") * 2).alias("transaction_id"),
            F.lit(None).cast("int").alias("discounted_units"),
            money(money("o_totalprice") * F.lit("0.05").cast("decimal(4,2)")).alias("discount_amount"),
            F.lit(1).alias("discount_sequence"),
            F.col("o_orderdate").alias("date_applied"),
            F.col("o_orderdate").alias("date_modified"),
        )
        return on_lines.unionByName(on_orders)

    @property
    def raw_payments(self) -> DataFrame:
        parts = (F.col("o_orderkey") % 3 + 1).cast("int")
        orders = self.table("orders").withColumn("_n", F.explode(F.sequence(F.lit(1), parts)))
        return orders.select(
            (F.col("o_orderkey") * 10 + F.col("_n")).alias("transaction_payment_id"),
            (F.col("o_orderkey") * 2).alias("transaction_id"),
            F.col("_n").alias("payment_type_id"),
            money(F.col("o_totalprice") / parts).alias("amount_paid"),
            F.lit(None).cast("string").alias("payment_provider_reference"),
            F.col("o_orderdate").alias("payment_date"),
            F.col("o_orderdate").alias("date_modified"),
        )

    @property
    def raw_supplier_bridge(self) -> DataFrame:
        """Product and supplier pairs from first to last shipment; some ended."""
        pairs = self.table("lineitem").groupBy("l_partkey", "l_suppkey").agg(
            F.min("l_shipdate").alias("date_added"),
            F.max("l_shipdate").alias("date_modified"),
            F.sum("l_linenumber").alias("_sum"),
        )
        ended = F.col("date_modified")
        return pairs.select(
            F.col("l_suppkey").alias("supplier_id"), F.col("l_partkey").alias("product_id"), "date_added",
            F.when(F.col("_sum") % 3 == 0, ended).alias("date_removed"), "date_modified",
            F.when(F.col("_sum") % 5 == 0, ended).alias("date_deleted"),
        )

    # Change feeds of the dimensions: (key, date_modified) and what changed.

    @property
    def customer_changes(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"),
            F.col("o_orderpriority").alias("status"), F.col("o_orderdate").alias("date_modified"),
        )

    def _first_of_period(self, table: str, key: str, at: str, unit: str, name: str) -> DataFrame:
        """A change of an entity whenever it shows up first in a period."""
        return (
            self.table(table).groupBy(F.col(key).alias(name), F.date_trunc(unit, at).alias("_period"))
            .agg(F.min(at).alias("date_modified")).drop("_period")
        )

    @property
    def product_changes(self) -> DataFrame:
        return self._first_of_period("lineitem", "l_partkey", "l_shipdate", "YEAR", "product_id")

    @property
    def supplier_changes(self) -> DataFrame:
        return self._first_of_period("lineitem", "l_suppkey", "l_shipdate", "YEAR", "supplier_id")

    @property
    def promotion_changes(self) -> DataFrame:
        return self._first_of_period("lineitem", "l_suppkey", "l_shipdate", "QUARTER", "promotion_id")

    @property
    def channel_changes(self) -> DataFrame:
        changes = self._first_of_period("orders", "o_orderpriority", "o_orderdate", "YEAR", "_priority")
        return changes.select(F.substring("_priority", 1, 1).cast("int").alias("channel_id"), "date_modified")

    @property
    def payment_type_changes(self) -> DataFrame:
        paid = self.raw_payments.groupBy("payment_type_id", F.year("payment_date").alias("_year"))
        return paid.agg(F.min("payment_date").alias("date_modified")).drop("_year")

    def history(self, changes: DataFrame, name: str, ties: list[str] | None = None) -> DataFrame:
        """Published history of a feed, under the names the facts look up."""
        built = build_history(changes, [f"{name}_id"], "date_modified", ties)
        return built.select(
            F.col("scd_id").alias(f"{name}_sk"), f"{name}_id",
            F.col("valid_from").alias("valid_from_ts"), F.col("valid_to").alias("valid_to_ts"),
        )

    def dims(self, *names: str) -> dict[str, DataFrame]:
        """Histories of the named entities, and the date dimension."""
        feeds = {
            "customers": ("customer", "customer_changes", ["order_id"]),
            "products": ("product", "product_changes", None),
            "channels": ("channel", "channel_changes", None),
            "promotions": ("promotion", "promotion_changes", None),
            "payment_types": ("payment_type", "payment_type_changes", None),
            "suppliers": ("supplier", "supplier_changes", None),
        }

        def built(name: str) -> DataFrame:
            singular, feed, ties = feeds[name]
            return materialise(self.history(getattr(self, feed), singular, ties), f"dim-{name}")

        # Tables, as in the warehouse: lookups go by their size as written, not by an estimate.
        tables = in_parallel([partial(built, name) for name in names])
        return {**dict(zip(names, tables, strict=True)), "date": self.dates}

    @property
    def days(self) -> DataFrame:
        """All days from the first order to the last shipment."""
        first = self.table("orders").agg(F.min(F.to_date("o_orderdate")).alias("d")).scalar()
        last = self.table("lineitem").agg(F.max(F.to_date("l_shipdate")).alias("d")).scalar()
        return self.spark.range(1).select(F.explode(F.sequence(first, last)).alias("full_date"))

    @property
    def holidays(self) -> DataFrame:
        day = F.date_format("full_date", "MM-dd")
        name = F.when(day == "12-25", "Christmas Day").when(day == "01-01", "New Year's Day")
        return self.days.select(F.col("full_date").alias("holiday_date"), name.alias("holiday_name")).filter(
            F.col("holiday_name").isNotNull()
        )

    @property
    def dates(self) -> DataFrame:
        return date_dimension(self.days, self.holidays)

    # Staged events.

    @property
    def lines(self) -> DataFrame:
        return stage_event(self.raw_lines, "transaction_lines", LINE_TIES)

    @property
    def headers(self) -> DataFrame:
        return stage_event(self.raw_headers, "transaction_headers")

    @property
    def discounts(self) -> DataFrame:
        return stage_event(self.raw_discounts, "transaction_discounts", DISCOUNT_TIES)

    @property
    def payments(self) -> DataFrame:
        return stage_event(self.raw_payments, "transaction_payments")

    @property
    def supplier_bridge(self) -> DataFrame:
        return stage_bridge(self.raw_supplier_bridge, "supplier_id")

    @property
    def prorated(self) -> DataFrame:
        lines = stage_event(self.raw_lines, "transaction_lines", PRORATED_TIES)
        headers = stage_event(self.raw_headers, "transaction_headers", HEADER_TIES)
        return facts.prorate_lines(lines, headers, self.discounts)

    @property
    def order_customers(self) -> DataFrame:
        """Latest headers for their customers: later columns than the customer settle no tie between those."""
        return stage_event(self.raw_headers, "transaction_headers", HEADER_TIES[:2]).select("transaction_id", "customer_id")
