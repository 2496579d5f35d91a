"""The retail entities: source keys, conformed names and mart columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import removal
from tidemark.operators.latest import latest_per_key
from tidemark.sources.tables import TableSpec

LIFECYCLE = {"date_added": "added_at", "date_removed": "removed_at", "date_modified": "modified_at"}


@dataclass(frozen=True)
class Entity:
    """`renames` maps source to conformed names; names not listed stay."""

    plural: str
    singular: str
    columns: tuple[str, ...]
    renames: dict[str, str] = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()
    mart_drops: tuple[str, ...] = ()
    mart_renames: dict[str, str] = field(default_factory=dict)
    lifecycle: bool = True
    current: bool = True

    @property
    def key(self) -> str:
        return f"{self.singular}_id"

    @property
    def sk(self) -> str:
        return f"{self.singular}_sk"

    @property
    def source_columns(self) -> list[str]:
        """Columns of the snapshot that the conformed view reads."""
        return [*self.columns, *(LIFECYCLE if self.lifecycle else {"date_modified": ""})]


ENTITIES = {
    e.plural: e
    for e in (
        Entity("authors", "author", ("author_id", "author_uuid", "author_name"),
               cluster_by=("author_id",), mart_drops=("modified_at",)),
        Entity("categories", "category", ("category_id", "category_name"),
               cluster_by=("updated_at", "category_id")),
        Entity("channels", "channel", ("channel_id", "channel_uuid", "channel_name"),
               mart_drops=("channel_uuid",), mart_renames={"modified_at": "source_modified_at"}),
        Entity("customers", "customer",
               ("customer_id", "customer_uuid", "first_name", "last_name", "email", "gender", "province",
                "date_of_birth", "status", "signup_platform", "registration_date"),
               {"status": "customer_status", "registration_date": "registered_at"},
               ("updated_at", "customer_id"), ("modified_at",), lifecycle=False),
        Entity("payment_types", "payment_type",
               ("payment_type_id", "payment_type_uuid", "type_name", "description"),
               {"type_name": "payment_type_name", "description": "payment_type_description"},
               ("payment_type_id",)),
        Entity("products", "product",
               ("product_id", "product_uuid", "name", "description", "year_published", "cost_price",
                "msrp", "unit_price", "status"),
               {"name": "product_name", "description": "product_description", "status": "product_status"},
               mart_drops=("added_at", "removed_at", "modified_at")),
        Entity("promotion_groups", "promotion_group",
               ("promotion_group_id", "group_name", "group_type", "description", "category_id"),
               {"group_name": "promotion_group_name", "description": "promotion_group_description"},
               ("updated_at", "promotion_group_id"), current=False),
        Entity("promotions", "promotion",
               ("promotion_id", "promotion_uuid", "promotion_name", "promotion_code", "description",
                "discount_level", "discount_pool", "stackable", "priority", "discount_type",
                "discount_value", "min_quantity", "min_subtotal", "promotion_group_id", "status",
                "start_date", "end_date"),
               {"description": "promotion_description", "status": "promotion_status",
                "start_date": "promotion_starts_at", "end_date": "promotion_ends_at"},
               ("updated_at", "promotion_id")),
        Entity("publishers", "publisher", ("publisher_id", "publisher_uuid", "publisher_name"),
               cluster_by=("publisher_id",)),
        Entity("suppliers", "supplier",
               ("supplier_id", "supplier_uuid", "supplier_name", "description", "country", "city",
                "province", "address", "postal_code", "contact_name", "contact_number", "contact_email"),
               {"description": "supplier_description", "address": "street_address"},
               ("supplier_id",)),
    )
}


def stage_entity(snapshot: DataFrame, entity: Entity) -> DataFrame:
    """Conformed names over the undeleted versions of a snapshot."""
    names = {c: entity.renames.get(c, c) for c in entity.columns}
    names |= LIFECYCLE if entity.lifecycle else {"date_modified": "modified_at"}
    return snapshot.filter(F.col("date_deleted").isNull()).select(
        "scd_id",
        *[F.col(source).alias(name) for source, name in names.items()],
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current_record"),
        F.col("scd_updated_at"),
    )


def history_dimension(staged: DataFrame, entity: Entity) -> DataFrame:
    """Published type 2 dimension of an entity."""
    meta = ("scd_id", "valid_from", "valid_to", "scd_updated_at", "is_current_record")
    attributes = [c for c in staged.columns if c not in meta and c not in entity.mart_drops]
    return staged.select(
        F.col("scd_id").alias(entity.sk),
        *[F.col(c).alias(entity.mart_renames.get(c, c)) for c in attributes],
        F.col("valid_from").alias("valid_from_ts"),
        F.col("valid_to").alias("valid_to_ts"),
        F.col("scd_updated_at").alias("updated_at"),
        "is_current_record",
    )


# Event tables: key and renames of the staged columns.
EVENTS = {
    "transaction_headers": ("transaction_id", {
        "transaction_id": "transaction_id", "transaction_uuid": "transaction_uuid",
        "channel_id": "channel_id", "employee_id": "employee_id", "customer_id": "customer_id",
        "gross_subtotal_amount": "gross_subtotal_amount", "total_tax_amount": "total_tax_amount",
        "total_amount": "total_amount", "transaction_type": "transaction_type",
        "original_transaction_id": "original_transaction_id",
        "transaction_date": "transaction_created_at", "date_modified": "modified_at"}),
    "transaction_lines": ("transaction_line_id", {
        "transaction_line_id": "transaction_line_id", "transaction_id": "transaction_id",
        "line_number": "line_number", "product_id": "product_id", "quantity": "quantity",
        "unit_price": "unit_price", "gross_line_total": "gross_line_total",
        "transaction_date": "line_created_at", "date_modified": "modified_at"}),
    "transaction_discounts": ("transaction_discount_id", {
        "transaction_discount_id": "transaction_discount_id", "promotion_id": "promotion_id",
        "transaction_line_id": "transaction_line_id", "transaction_id": "transaction_id",
        "discounted_units": "discounted_units", "discount_amount": "discount_amount",
        "discount_sequence": "discount_sequence", "date_applied": "applied_at",
        "date_modified": "modified_at"}),
    "transaction_payments": ("transaction_payment_id", {
        "transaction_payment_id": "transaction_payment_id", "transaction_id": "transaction_id",
        "payment_type_id": "payment_type_id", "amount_paid": "amount_paid",
        "payment_provider_reference": "payment_provider_reference",
        "payment_date": "payment_processed_at", "date_modified": "modified_at"}),
}


def stage_event(raw: DataFrame, table: str, ties: list[str] | None = None) -> DataFrame:
    """Latest row per event, under conformed names."""
    key, names = EVENTS[table]
    newest = latest_per_key(raw, [key], "date_modified", ties)
    return newest.select(*[F.col(source).alias(name) for source, name in names.items()])


def stage_bridge(raw: DataFrame, entity_key: str, ties: list[str] | None = None) -> DataFrame:
    """Latest row per pair, with when and why it ended."""
    newest = latest_per_key(raw, [entity_key, "product_id"], "date_modified", ties)
    return newest.select(
        entity_key,
        "product_id",
        F.col("date_added").alias("added_at"),
        F.col("date_modified").alias("modified_at"),
        *removal(),
    )


@dataclass(frozen=True)
class Bridge:
    """A product bridge: its raw table, its mart table and the other entity."""

    raw: str
    mart: str
    entity: str

    @property
    def sk(self) -> str:
        return f"product_{ENTITIES[self.entity].singular}_sk"


BRIDGES = (
    Bridge("authors_products", "brg_products_authors_history", "authors"),
    Bridge("categories_products", "brg_products_categories_history", "categories"),
    Bridge("publishers_products", "brg_products_publishers_history", "publishers"),
    Bridge("suppliers_products", "brg_products_suppliers_history", "suppliers"),
    Bridge("promotion_groups_products", "brg_product_promotion_group_history", "promotion_groups"),
)

CLEAN = {
    e.plural: TableSpec(e.plural, (e.key,), "date_modified", "MONTH", (e.key,), "date_modified")
    for e in ENTITIES.values()
}
SNAPSHOTS = {
    e.plural: TableSpec(e.plural, ("scd_id",), "scd_updated_at", "MONTH", (e.key,), fixed_partition=True,
                        bounds=("scd_updated_at",))
    for e in ENTITIES.values()
}
PREP = TableSpec("transaction_lines_proration", ("transaction_line_id",), "line_created_at", "DAY",
                 ("transaction_id",), "modified_at", bounds=("changed_at",), lookups=("transaction_id",))
HISTORY = {
    e.plural: TableSpec(f"dim_{e.plural}_history", (e.sk,), "valid_from_ts", "MONTH",
                        e.cluster_by, fixed_partition=True, bounds=("updated_at",))
    for e in ENTITIES.values()
}
CURRENT = {
    e.plural: TableSpec(f"dim_{e.plural}", (e.key,), incremental=False)
    for e in ENTITIES.values() if e.current and e.plural != "customers"
}
CURRENT["customers"] = TableSpec("dim_customers", ("customer_id",), "registered_at", "MONTH",
                                 ("province", "signup_platform"), "updated_at")
FACTS = {
    "fct_sales": TableSpec("fct_sales", ("transaction_line_id",), "sale_event_ts", "DAY",
                           ("product_sk", "customer_sk"), "source_modified_at"),
    "fct_returns": TableSpec("fct_returns", ("transaction_line_id",), "line_created_at", "DAY",
                             ("product_sk", "channel_sk", "customer_sk"), "source_modified_at"),
    "fct_transactions": TableSpec("fct_transactions", ("transaction_id",), "line_created_at", "DAY",
                                  ("customer_sk", "channel_sk"), "modified_at"),
    "fct_payments": TableSpec("fct_payments", ("transaction_payment_id",), "payment_event_ts", "DAY",
                              ("payment_type_sk",), "source_updated_at"),
    "fct_discounts": TableSpec("fct_discounts", ("transaction_discount_id",), "discount_event_ts", "DAY",
                               ("product_sk", "customer_sk", "promotion_sk"), "source_modified_at"),
}
BRIDGE_TABLES = {
    b.mart: TableSpec(b.mart, (b.sk,), "relationship_started_at", "MONTH",
                      (ENTITIES[b.entity].sk, "product_sk"), "relationship_modified_at")
    for b in BRIDGES
}
DIM_DATE = TableSpec("dim_date", ("date_key",), incremental=False)
MART_TABLES: dict[str, TableSpec] = {
    "dim_date": DIM_DATE,
    **{s.name: s for s in HISTORY.values()},
    **{s.name: s for s in CURRENT.values()},
    **BRIDGE_TABLES,
    **FACTS,
}
