"""Promotion eligibility, order totals and payment split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import MONEY, money
from tidemark.operators.latest import first_per_key
from tidemark.operators.sets import union_distinct

TAX_RATE = "0.12"


def eligible_products(
    categories_products: DataFrame, groups: DataFrame, groups_products: DataFrame
) -> DataFrame:
    """Products in a promotion group, through a category or directly."""
    by_category = groups.filter(F.col("group_type") == "Category").select("category_id", "promotion_group_id")
    through = categories_products.join(by_category, "category_id")
    return union_distinct(
        through.select("product_id", "promotion_group_id"),
        groups_products.select("product_id", "promotion_group_id"),
    )


def group_of_product(eligible: DataFrame) -> DataFrame:
    """One group per product: the one with the smallest id."""
    return first_per_key(eligible, ["product_id"], ["promotion_group_id"])


def ungrouped(promotions: DataFrame, level: str) -> DataFrame:
    """Promotions of a level that belong to no group."""
    return promotions.filter((F.col("discount_level") == level) & F.col("promotion_group_id").isNull())


def order_totals(lines: DataFrame, line_discounts: DataFrame, order_discounts: DataFrame) -> DataFrame:
    """Gross, discounts, tax and total per order; none of them below zero.

    Order discounts are an amount (FLAT) or a share (PERCENT, at most all) of
    what the line discounts left; another pool is an error.
    """
    gross = lines.groupBy("transaction_id").agg(F.sum(money("gross_line_total")).alias("gross_subtotal"))
    off_lines = line_discounts.groupBy("transaction_id").agg(F.sum(money("discount_amount")).alias("_off_lines"))
    orders = gross.join(off_lines, "transaction_id", "left").join(
        order_discounts.select("transaction_id", "discount_pool", "discount_value"), "transaction_id", "left"
    )
    zero = F.lit(0).cast(MONEY)
    off_lines_amount = F.coalesce("_off_lines", zero)
    left_over = F.col("gross_subtotal") - off_lines_amount
    share = F.least(F.col("discount_value") / F.lit(100), F.lit(1).cast("decimal(10,6)"))
    off_order = F.coalesce(
        F.when(F.col("discount_pool") == "FLAT", money("discount_value")).when(
            F.col("discount_pool") == "PERCENT", money(left_over * share)
        ).when(
            F.col("discount_pool").isNotNull(),
            F.raise_error(F.concat(F.lit("unknown pool of an order discount: "), "discount_pool")).cast(MONEY),
        ),
        zero,
    )
    net = money(F.greatest(left_over - F.col("order_discount"), zero))
    return (
        orders.withColumn("line_discounts", off_lines_amount)
        .withColumn("order_discount", off_order)
        .withColumn("net_total", net)
        .withColumn("tax_amount", money(F.col("net_total") * F.lit(TAX_RATE).cast("decimal(4,2)")))
        .withColumn("total_amount", money(F.col("net_total") + F.col("tax_amount")))
        .select("transaction_id", "gross_subtotal", "line_discounts", "order_discount", "net_total",
                "tax_amount", "total_amount")
    )


def split_payments(orders: DataFrame, amount: str, parts: str) -> DataFrame:
    """Equal payments of an order, numbered from 1; an order without value is paid once."""
    n = F.when(F.col(amount) > 0, F.col(parts).cast("int")).otherwise(F.lit(1))
    return orders.withColumn("_parts", n).withColumn(
        "payment_number", F.explode(F.sequence(F.lit(1), F.col("_parts")))
    ).withColumn(
        "amount_paid", money(F.col(amount).cast("double") / F.col("_parts").cast("double"))
    ).drop("_parts")
