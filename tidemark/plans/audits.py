"""Audits of the mart tables and constraints of the source tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.audit import Relationship, TableAudit, audit_table
from tidemark.plans.entities import BRIDGES, ENTITIES


def _keyed(key: str, *parents: tuple[str, str]) -> TableAudit:
    links = tuple(Relationship(column, parent, column) for column, parent in parents)
    return TableAudit(not_null=(key,), unique=(key,), relationships=links)


_CUSTOMER = ("customer_sk", "dim_customers_history")
_PRODUCT = ("product_sk", "dim_products_history")
_CHANNEL = ("channel_sk", "dim_channels_history")

MART_AUDITS: dict[str, TableAudit] = {
    "dim_date": _keyed("date_key"),
    **{f"dim_{e.plural}_history": _keyed(e.sk) for e in ENTITIES.values()},
    **{f"dim_{e.plural}": _keyed(e.key) for e in ENTITIES.values() if e.current},
    **{
        b.mart: _keyed(b.sk, _PRODUCT, (ENTITIES[b.entity].sk, f"dim_{b.entity}_history"))
        for b in BRIDGES
    },
    "fct_sales": _keyed("transaction_line_id", _CUSTOMER, _PRODUCT, _CHANNEL),
    "fct_returns": _keyed("transaction_line_id", _CUSTOMER, _PRODUCT, _CHANNEL),
    "fct_transactions": _keyed("transaction_id", _CUSTOMER, _CHANNEL),
    "fct_payments": _keyed("transaction_payment_id", ("payment_type_sk", "dim_payment_types_history")),
    "fct_discounts": _keyed(
        "transaction_discount_id", _CUSTOMER, ("promotion_sk", "dim_promotions_history")
    ),
}


def _one_of(column: str, *values: str) -> Column:
    return F.col(column).isin(*values)


def _removed_after_added() -> Column:
    return F.col("date_removed").isNull() | (F.col("date_removed") >= F.col("date_added"))


def _source(
    keys: tuple[str, ...], required: tuple[str, ...] = (), unique: tuple[str, ...] = (),
    links: tuple[tuple[str, str], ...] = (), checks: dict[str, Column] | None = None,
) -> TableAudit:
    return TableAudit(
        not_null=(*keys, *required),
        unique=(*(keys if len(keys) == 1 else ()), *unique),
        relationships=tuple(Relationship(c, parent, c) for c, parent in links),
        checks=checks or {},
    )


def source_audits() -> dict[str, TableAudit]:
    """Constraints of the source schema. Built on call: they are Spark expressions."""
    line, order = F.col("transaction_line_id"), F.col("transaction_id")
    units = F.col("discounted_units")
    bridges = {
        b.raw: _source((ENTITIES[b.entity].key, "product_id"), ("date_added",),
                       links=(("product_id", "products"), (ENTITIES[b.entity].key, b.entity)))
        for b in BRIDGES
    }
    return {
        "transaction_headers": _source(
            ("transaction_id",),
            ("transaction_uuid", "channel_id", "customer_id", "gross_subtotal_amount",
             "total_tax_amount", "total_amount", "transaction_date"),
            ("transaction_uuid",), (("channel_id", "channels"), ("customer_id", "customers")),
            {
                "transaction_type": _one_of("transaction_type", "Purchase", "Return"),
                "return_has_original": (F.col("transaction_type") == "Purchase")
                | F.col("original_transaction_id").isNotNull(),
            },
        ),
        "transaction_lines": _source(
            ("transaction_line_id",),
            ("transaction_id", "line_number", "product_id", "quantity", "unit_price",
             "gross_line_total", "transaction_date"),
            links=(("transaction_id", "transaction_headers"), ("product_id", "products")),
            checks={"gross_not_negative": F.col("gross_line_total") >= 0},
        ),
        "transaction_discounts": _source(
            ("transaction_discount_id",), ("promotion_id", "discount_amount", "date_applied"),
            links=(("promotion_id", "promotions"), ("transaction_line_id", "transaction_lines"),
                   ("transaction_id", "transaction_headers")),
            checks={
                "line_or_order": line.isNull() != order.isNull(),
                "units_on_lines_only": line.isNull() == units.isNull(),
            },
        ),
        "transaction_payments": _source(
            ("transaction_payment_id",), ("transaction_id", "payment_type_id", "amount_paid", "payment_date"),
            links=(("transaction_id", "transaction_headers"), ("payment_type_id", "payment_types")),
            checks={"amount_not_negative": F.col("amount_paid") >= 0},
        ),
        "customers": _source(
            ("customer_id",),
            ("customer_uuid", "first_name", "last_name", "email", "gender", "province",
             "signup_platform", "registration_date"),
            ("email",),
            checks={
                "gender": _one_of("gender", "M", "F"),
                "status": _one_of("status", "Active", "Inactive", "Banned"),
                "signup_platform": _one_of("signup_platform", "Android", "IOS", "Browser"),
            },
        ),
        "promotions": _source(
            ("promotion_id",),
            ("promotion_uuid", "promotion_name", "discount_level", "priority", "discount_type",
             "discount_value", "start_date", "date_added"),
            ("promotion_code",), (("promotion_group_id", "promotion_groups"),),
            {
                "discount_level": _one_of("discount_level", "LINE_ITEM", "ORDER"),
                "discount_pool": _one_of("discount_pool", "PERCENT", "FLAT", "BOGO", "FIXED"),
                "discount_type": _one_of("discount_type", "PERCENT", "FLAT", "FIXED"),
                "status": _one_of("status", "Active", "Expired", "Upcoming"),
                "ends_after_start": F.col("end_date").isNull() | (F.col("end_date") >= F.col("start_date")),
            },
        ),
        "promotion_groups": _source(
            ("promotion_group_id",), ("group_name", "group_type", "date_added"),
            links=(("category_id", "categories"),),
            checks={
                "group_type": _one_of("group_type", "Custom", "Category"),
                "category_of_category_group": F.col("category_id").isNull()
                | (F.col("group_type") == "Category"),
            },
        ),
        "channels": _source(
            ("channel_id",), ("channel_uuid", "channel_name", "channel_type", "date_added"), ("channel_name",),
            checks={
                "channel_type": _one_of(
                    "channel_type", "Online", "In-Store", "Mobile App", "Third-Party", "Marketplace"),
                "removed_after_added": _removed_after_added(),
            },
        ),
        "payment_types": _source(
            ("payment_type_id",), ("payment_type_uuid", "type_name", "date_added"), ("type_name",)),
        "products": _source(("product_id",), ("product_uuid", "name", "date_added")),
        "authors": _source(("author_id",), ("author_uuid", "author_name", "date_added")),
        "categories": _source(("category_id",), ("category_name", "date_added")),
        "publishers": _source(("publisher_id",), ("publisher_uuid", "publisher_name", "date_added")),
        "suppliers": _source(("supplier_id",), ("supplier_uuid", "supplier_name", "date_added")),
        "employees": _source(("employee_id",), ("email", "date_hired")),
        **bridges,
    }


def audit_sources(tables: dict[str, DataFrame], names: Iterable[str] | None = None) -> DataFrame:
    """One report over the source tables `names` (all given), with table_name; the other tables serve as parents.

    A table without constraints has no rows in it. A parent that isn't given is
    an error, as its children can't be checked.
    """
    audits = source_audits()
    wanted = [n for n in (tables if names is None else names) if n in audits]
    missing = {r.parent for n in wanted for r in audits[n].relationships} - set(tables)
    if missing:
        raise ValueError(f"tables that others refer to are missing: {', '.join(sorted(missing))}")
    reports = [audit_table(tables[n], audits[n], tables).withColumn("table_name", F.lit(n)) for n in wanted]
    return reduce(DataFrame.unionByName, reports)
