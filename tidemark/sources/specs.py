"""Ingest jobs as data: what to extract, how to lay it out, how to load it."""

from __future__ import annotations

from dataclasses import dataclass

from tidemark.functions.dates import GRAINS

MODES = ("NULLABLE", "REQUIRED", "REPEATED")
PARTITION_TYPES = ("HOUR", "DAY", "MONTH", "YEAR")


def _one_of(value: str, accepted: tuple[str, ...], what: str) -> None:
    if value not in accepted:
        raise ValueError(f"invalid {what}: {value!r}, must be one of {accepted}")


def _identifier(name: str) -> None:
    if not name.isidentifier():
        raise ValueError(f"{name!r} is not a valid identifier")


@dataclass(frozen=True)
class FieldSpec:
    """One column of an explicit schema; `rounding` is HALF_UP or HALF_EVEN."""

    name: str
    type: str = "string"
    mode: str = "NULLABLE"
    rounding: str | None = None

    def __post_init__(self) -> None:
        _identifier(self.name)
        _one_of(self.mode, MODES, "mode")
        if self.rounding is not None:
            _one_of(self.rounding, ("HALF_UP", "HALF_EVEN"), "rounding")


@dataclass(frozen=True)
class ExtractSpec:
    """A windowed extract. `chunk_size` bounds the rows of a file."""

    table: str
    date_field: str = "date_modified"
    grain: str = "daily"
    layout: str | None = None
    columns: tuple[str, ...] = ()
    load_all_columns: bool = True
    chunk_size: int | None = 32_768
    compression: str | None = None

    def __post_init__(self) -> None:
        for name in (self.table, self.date_field, *self.columns):
            _identifier(name)
        _one_of(self.grain, GRAINS, "grain")
        if self.layout is not None:
            _one_of(self.layout, ("daily", "weekly", "monthly"), "layout")
        if self.chunk_size is not None and self.chunk_size <= 0:
            raise ValueError("chunk_size must be positive")

    @property
    def lake_layout(self) -> str:
        return self.layout or self.grain

    @property
    def codec(self) -> str:
        return self.compression or "zstd"


@dataclass(frozen=True)
class LoadSpec:
    """A raw table: optional explicit schema, time partitioning and clustering."""

    table: str
    fields: tuple[FieldSpec, ...] = ()
    partition_field: str | None = None
    partition_type: str = "DAY"
    expiration_days: int | None = None
    cluster_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        _identifier(self.table)
        _one_of(self.partition_type, PARTITION_TYPES, "partition_type")
        if self.expiration_days is not None and not 1 <= self.expiration_days <= 365:
            raise ValueError("expiration_days must be between 1 and 365")
        if len(self.cluster_by) > 4:
            raise ValueError("at most four clustering columns")


BRIDGES = ("authors_products", "categories_products", "publishers_products",
           "suppliers_products", "promotion_groups_products")
ENTITY_TABLES = ("authors", "categories", "channels", "customers", "payment_types",
                 "products", "promotion_groups", "promotions", "publishers", "suppliers")
EVENT_TABLES = ("transaction_headers", "transaction_lines", "transaction_discounts",
                "transaction_payments")
EXTRACTS = tuple(ExtractSpec(t) for t in (*ENTITY_TABLES, *EVENT_TABLES, *BRIDGES))
LOADS = (
    LoadSpec("date_dimension", partition_field="full_date", partition_type="YEAR",
             cluster_by=("year_number", "quarter_number", "month_number")),
    *(LoadSpec(e.table, partition_field="date_modified") for e in EXTRACTS),
)
