"""The retail facts and version bridges as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import surrogate_key
from tidemark.functions.measures import MONEY, discount_level, money, signed
from tidemark.operators.allocation import allocate, total_by
from tidemark.operators.incremental import all_rows_of_changed
from tidemark.operators.pointintime import date_key, pit_join, pit_keys
from tidemark.operators.sets import rows_of, rows_of_either, spread_join

MEASURES = [
    "gross_line_total", "line_discount_amount", "prorated_discount_amount", "total_discount_amount",
    "pretax_net_amount", "prorated_tax_amount", "net_amount",
]


def prorate_lines(
    lines: DataFrame, headers: DataFrame, discounts: DataFrame, changed: DataFrame | None = None
) -> DataFrame:
    """Spread header discounts and tax over the lines of each transaction.

    `changed` restricts the work to the transactions it names; all of their
    lines are used, because the shares need the whole subtotal.
    """
    if changed is not None:
        lines = all_rows_of_changed(lines, changed, ["transaction_id"])
        headers = rows_of(headers, changed, ["transaction_id"])
    by_line, by_order = _discount_totals(discounts)
    netted = (
        lines.select("transaction_line_id", "transaction_id", "line_number", "product_id", "quantity",
                     "gross_line_total", "line_created_at", "modified_at")
        .join(by_line, "transaction_line_id", "left")
        .withColumn("gross_line_total", money("gross_line_total"))
        .withColumn("line_discount_amount", F.coalesce("_line_discount", F.lit(0).cast(MONEY)))
        .drop("_line_discount")
    )
    net = money(F.col("gross_line_total") - F.col("line_discount_amount"))
    orders = headers.select(
        "transaction_id", "transaction_uuid", "transaction_type", "original_transaction_id",
        "customer_id", "channel_id", money("total_tax_amount").alias("_header_tax"),
    ).join(by_order, "transaction_id", "left")
    spread = allocate(
        netted, orders, ["transaction_id"], net,
        {"_header_discount": "prorated_discount_amount", "_header_tax": "prorated_tax_amount"},
        keep=["transaction_uuid", "transaction_type", "original_transaction_id", "customer_id", "channel_id"],
    )
    return spread.withColumns(_line_sums()).select(
        "transaction_line_id", "transaction_id", "line_number", "transaction_uuid", "transaction_type",
        "original_transaction_id", "customer_id", "channel_id", "product_id", "quantity", *MEASURES,
        "line_created_at", "modified_at",
    )


def _discount_totals(discounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Discounts per line and per order.

    One aggregate by either id, whose rows both sides take as they are: the
    discounts are shuffled once, to where the lines and orders of that id are.
    """
    line, order = F.col("transaction_line_id").cast("long"), F.col("transaction_id").cast("long")
    kinds = F.array(F.struct(F.lit(False).alias("on_order"), line.alias("id")), F.struct(F.lit(True).alias("on_order"), order.alias("id")))
    rows = discounts.select(money("discount_amount").alias("_amount"), F.explode(kinds).alias("_of")).filter("_of.id IS NOT NULL")
    value = F.coalesce("_amount", F.lit(0).cast(MONEY))
    totals = rows.groupBy(F.col("_of.id").alias("_id")).agg(*[
        F.sum(F.when(F.col("_of.on_order") == on_order, value)).cast(MONEY).alias(name)
        for name, on_order in (("_line_discount", False), ("_header_discount", True))
    ])
    # Always true, but it names all columns, so that both sides keep the same ones and share the shuffle.
    alike = F.pmod(F.xxhash64(*totals.columns), F.lit(1).cast("long")) == 0

    def of(id_name: str, amount: str) -> DataFrame:
        return totals.filter(F.col(amount).isNotNull() & alike).select(F.col("_id").alias(id_name), amount)

    return of("transaction_line_id", "_line_discount"), of("transaction_id", "_header_discount")


def _line_sums() -> dict[str, Column]:
    """Measures of a line that follow from its others."""
    off = F.col("line_discount_amount") + F.col("prorated_discount_amount")
    pretax = F.col("gross_line_total") - off
    return {
        "total_discount_amount": money(off), "pretax_net_amount": money(pretax),
        "net_amount": money(pretax + F.col("prorated_tax_amount")),
    }


def _line_fact(prorated: DataFrame, kind: str, dims: dict[str, DataFrame], key_name: str) -> DataFrame:
    # Sums of other measures are made after the lookups rather than moved through them.
    unread = {"transaction_type"} | ({"original_transaction_id"} if kind == "Purchase" else set())
    lines = prorated.filter(F.col("transaction_type") == kind).drop(*_line_sums(), *unread)
    keyed = pit_keys(
        lines,
        [
            {"versions": dims["products"], "on": [("product_id", "product_id")], "sk": "product_sk"},
            {"versions": dims["customers"], "on": [("customer_id", "customer_id")], "sk": "customer_sk"},
            {"versions": dims["channels"], "on": [("channel_id", "channel_id")], "sk": "channel_sk"},
        ],
        "line_created_at", by=["transaction_line_id"],
    ).withColumns(_line_sums())
    return date_key(keyed, dims["date"], "line_created_at", key_name)


def sales(prorated: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return _line_fact(prorated, "Purchase", dims, "sale_date_key").select(
        "transaction_line_id", "transaction_id", "line_number", "transaction_uuid",
        "customer_sk", "channel_sk", "product_sk", "quantity", *MEASURES, "sale_date_key",
        F.col("line_created_at").alias("sale_event_ts"),
        F.col("modified_at").alias("source_modified_at"),
    )


def returns(prorated: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return _line_fact(prorated, "Return", dims, "return_date_key").select(
        "transaction_line_id", "line_number", "transaction_id", "transaction_uuid",
        "original_transaction_id", "customer_sk", "channel_sk", "product_sk", "quantity", *MEASURES,
        "return_date_key", "line_created_at", F.col("modified_at").alias("source_modified_at"),
    )


def signed_totals(prorated: DataFrame) -> DataFrame:
    """Transaction grain: returns count negative; header attributes collapse to one row."""
    amounts = {
        "gross_subtotal_amount": "gross_line_total", "total_discount_amount": "total_discount_amount",
        "total_tax_amount": "prorated_tax_amount", "net_amount": "net_amount",
    }
    firsts = ["transaction_uuid", "transaction_type", "original_transaction_id", "customer_id",
              "channel_id", "line_created_at"]
    return prorated.groupBy("transaction_id").agg(
        *[F.min(c).alias(c) for c in firsts],
        F.max("modified_at").alias("modified_at"),
        *[
            F.coalesce(F.sum(signed(source)), F.lit(0)).cast(MONEY).alias(out)
            for out, source in amounts.items()
        ],
    )


def transactions(prorated: DataFrame, dims: dict[str, DataFrame], changed: DataFrame | None = None) -> DataFrame:
    """`total_amount` adds tax to a net amount that holds it already, as the
    reports it replaces do; `total_amount_tax_once` does not."""
    if changed is not None:
        prorated = all_rows_of_changed(prorated, changed, ["transaction_id"])
    keyed = pit_keys(
        signed_totals(prorated),
        [
            {"versions": dims["customers"], "on": [("customer_id", "customer_id")], "sk": "customer_sk"},
            {"versions": dims["channels"], "on": [("channel_id", "channel_id")], "sk": "channel_sk"},
        ],
        "line_created_at", by=["transaction_id"],
    )
    dated = date_key(keyed, dims["date"], "line_created_at", "transaction_date_key")
    return dated.select(
        "transaction_id", "transaction_uuid", "transaction_type", "original_transaction_id",
        "customer_sk", "channel_sk", "transaction_date_key",
        "gross_subtotal_amount", "total_discount_amount", "total_tax_amount", "net_amount",
        money(F.col("net_amount") + F.col("total_tax_amount")).alias("total_amount"),
        F.col("net_amount").alias("total_amount_tax_once"),
        "line_created_at", "modified_at",
    )


def payments(staged: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Payment type as of the last change; the key stays null where none was valid."""
    keyed = pit_join(
        staged, payment_types, [("payment_type_id", "payment_type_id")], "modified_at",
        {"payment_type_sk": "payment_type_sk"},
    )
    return keyed.select(
        "transaction_payment_id", "payment_type_sk", "transaction_id", "payment_type_id",
        "payment_provider_reference", "amount_paid",
        F.col("payment_processed_at").alias("payment_event_ts"),
        F.col("modified_at").alias("source_updated_at"),
    )


def discount_keys(
    discounts: DataFrame, lines: DataFrame, headers: DataFrame, reduce: bool = True, by: list[str] | None = None
) -> DataFrame:
    """Product and customer of each discount: through its line, else through its header.

    `reduce` first keeps the lines and headers that the discounts name. That pays
    off for a batch, whose keys are few enough to broadcast, not for a full run.
    Discounts without a line or order are spread by the columns `by`, all by default.
    """
    lines = lines.select("transaction_line_id", F.col("transaction_id").alias("_line_order"), "product_id")
    headers = headers.select("transaction_id", "customer_id")
    if reduce:
        lines = rows_of(lines, discounts, ["transaction_line_id"])
        headers = rows_of_either(
            headers, "transaction_id", discounts.select("transaction_id"), lines.select("_line_order"))
    # A discount has a line or an order of its own: on either path many have no key.
    with_line = spread_join(
        discounts, lines.withColumnRenamed("transaction_line_id", "_line"), [("transaction_line_id", "_line")], by=by).drop("_line")
    # One lookup serves both paths: of the line's order, or else of the discount's own.
    first = with_line.withColumn("_order", F.coalesce("_line_order", "transaction_id"))
    found = spread_join(first, headers.toDF("_header", "customer_id"), [("_order", "_header")], by=by).drop("_header", "_order")
    # Where both are there the line's order may have no customer, but the own one.
    both = F.col("_line_order").isNotNull() & F.col("transaction_id").isNotNull()
    open_ = F.coalesce(both & F.col("customer_id").isNull(), F.lit(False))
    columns = [*with_line.drop("_line_order").columns, "customer_id"]
    own = spread_join(
        found.filter(both & F.col("customer_id").isNull()).drop("customer_id"), headers.toDF("_header", "customer_id"),
        [("transaction_id", "_header")], by=by)
    return found.filter(~open_).select(*columns).unionByName(own.select(*columns))


def discounts(
    staged: DataFrame, lines: DataFrame, headers: DataFrame, dims: dict[str, DataFrame], batch: bool = False
) -> DataFrame:
    """`batch`: the discounts are a small part of all."""
    keyed = pit_keys(
        discount_keys(staged, lines, headers, reduce=batch, by=["transaction_discount_id"]),
        [
            {"versions": dims["promotions"], "on": [("promotion_id", "promotion_id")], "sk": "promotion_sk"},
            {"versions": dims["customers"], "on": [("customer_id", "customer_id")], "sk": "customer_sk"},
            {"versions": dims["products"], "on": [("product_id", "product_id")], "sk": "product_sk"},
        ],
        "applied_at", by=["transaction_discount_id"],
    )
    dated = date_key(keyed, dims["date"], "applied_at", "discount_date_key")
    return dated.select(
        "transaction_discount_id", "customer_sk", "product_sk", "promotion_sk", "discount_date_key",
        "transaction_id", "transaction_line_id", discount_level().alias("discount_level"),
        "discounted_units", "discount_amount", "discount_sequence",
        F.col("applied_at").alias("discount_event_ts"),
        F.col("modified_at").alias("source_modified_at"),
    )


def version_bridge(
    staged: DataFrame, left: DataFrame, right: DataFrame, left_name: str, right_name: str,
    out: str, by_start: bool = False, keep_unmatched: bool = False,
) -> DataFrame:
    """Versions of both sides of a relation.

    A version matches when it began before the relation and outlived its last
    change, so a relation edited across a version boundary matches none. With
    `by_start` only the start of the relation counts. `keep_unmatched` keys the
    pairs without a version on both sides by their ids too: such pairs share
    their null keys, and a table keyed by `out` alone would keep one of them.
    """
    until = None if by_start else "modified_at"
    pairs = staged
    for dim, name in ((left, left_name), (right, right_name)):
        key, sk = f"{name}_id", f"{name}_sk"
        pairs = pit_join(pairs, dim, [(key, key)], "added_at", {sk: sk}, until=until, counted=staged)
    left_sk, right_sk = f"{left_name}_sk", f"{right_name}_sk"
    key = surrogate_key(left_sk, right_sk)
    if keep_unmatched:
        matched = F.col(left_sk).isNotNull() & F.col(right_sk).isNotNull()
        key = F.when(matched, key).otherwise(surrogate_key(left_sk, right_sk, f"{left_name}_id", f"{right_name}_id"))
    return pairs.select(
        key.alias(out), left_sk, right_sk,
        F.col("added_at").alias("relationship_started_at"),
        F.col("modified_at").alias("relationship_modified_at"),
        F.col("removed_at").alias("relationship_ended_at"),
        F.col("removal_reason").alias("relationship_end_reason"),
    )
