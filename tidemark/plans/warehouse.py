"""The retail warehouse, layer by layer."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.history import build_history, current_rows, history_changes
from tidemark.operators.incremental import RunWindow, changed_rows
from tidemark.plans import facts
from tidemark.operators.audit import require_clean
from tidemark.operators.latest import latest_per_key
from tidemark.plans.audits import MART_AUDITS, audit_sources
from tidemark.plans.entities import (
    BRIDGE_TABLES, BRIDGES, Bridge, CLEAN, CURRENT, DIM_DATE, ENTITIES, FACTS, HISTORY, MART_TABLES, PREP,
    SNAPSHOTS, history_dimension, stage_bridge, stage_entity,
)
from tidemark.plans.proration import Proration
from tidemark.plans.publish import Roles, audit_and_publish, prepare_audit, read_roles
from tidemark.session import in_parallel, materialise
from tidemark.sources.specs import LOADS
from tidemark.sources.tables import (
    TableSpec, append_rows, changed_in_run, create_database, read_table, remove_keys, replace_table, rows_with_keys, table_exists, upsert,
)

LAYERS = {
    "raw": "append-only source rows",
    "clean": "latest source row per key",
    "snapshots": "history of the clean rows",
    "staging": "conformed names, as views",
    "prep": "shared heavy transformations",
    "mart_blue": "marts, live or under audit",
    "mart_green": "marts, live or under audit",
    "live": "views on the live marts",
}
RAW_KEYS = {
    **{e.plural: (e.key,) for e in ENTITIES.values()},
    **{b.raw: (ENTITIES[b.entity].key, "product_id") for b in BRIDGES},
    "transaction_headers": ("transaction_id",),
    "transaction_lines": ("transaction_line_id",),
    "transaction_discounts": ("transaction_discount_id",),
    "transaction_payments": ("transaction_payment_id",),
    "date_dimension": ("date_key",),
}
RAW = {
    s.table: TableSpec(s.table, RAW_KEYS[s.table], s.partition_field, s.partition_type, s.cluster_by,
                       bounds=("date_modified",) if s.partition_field == "date_modified" else ())
    for s in LOADS
}


@dataclass(frozen=True)
class Warehouse:
    """Databases are named `<prefix>_<layer>`."""

    spark: SparkSession
    prefix: str = "retail"
    lookback_days: int = 3
    # Whether a relation is matched to versions by its start alone; else by its last change too.
    bridges_by_start: bool = True

    def db(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def create(self) -> None:
        for layer, comment in LAYERS.items():
            labels = {"layer": layer}
            if layer.startswith("mart_"):
                labels["deployment_status"] = "live" if layer == "mart_blue" else "audit"
            create_database(self.spark, self.db(layer), comment, labels)

    def _table(self, layer: str, name: str) -> str:
        return f"{self.db(layer)}.{name}"

    def _existing(self, table: str) -> DataFrame | None:
        return read_table(self.spark, table) if table_exists(self.spark, table) else None

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self._table("raw", name))

    def load_raw(self, name: str, rows: DataFrame, load: str | None = None) -> None:
        append_rows(rows, self._table("raw", name), RAW[name], load)

    @property
    def proration(self) -> Proration:
        return Proration(self.spark, *[partial(self._table, layer) for layer in ("raw", "clean", "prep")], self.lookback_days)

    # Layers below the marts -------------------------------------------------

    def build_clean(self, window: RunWindow, names: Iterable[str] = tuple(CLEAN)) -> None:
        def build(name: str) -> None:
            table = self._table("clean", name)
            rows = changed_in_run(
                self.spark, self._table("raw", name), "date_modified", window, table, "date_modified", 1, whole_days=False)
            upsert(rows, table, CLEAN[name])

        in_parallel([partial(build, name) for name in names])

    def source_report(self) -> DataFrame:
        """Violations of the source constraints in the latest rows of all source tables that are loaded."""

        def latest(name: str) -> DataFrame | None:
            if name in CLEAN:
                return self._existing(self._table("clean", name))
            rows = self._existing(self._table("raw", name))
            return rows if rows is None else latest_per_key(rows, list(RAW_KEYS[name]), "date_modified")

        found = {name: latest(name) for name in RAW if name != "date_dimension"}
        return audit_sources({name: rows for name, rows in found.items() if rows is not None})

    def build_snapshots(self, names: Iterable[str] = tuple(SNAPSHOTS)) -> None:
        def build(name: str) -> None:
            entity, table = ENTITIES[name], self._table("snapshots", name)
            clean = read_table(self.spark, self._table("clean", name))
            existing = self._existing(table)
            if existing is None:
                rows = build_history(clean, [entity.key], "date_modified")
            else:
                rows = history_changes(existing, clean, [entity.key], "date_modified")
            upsert(rows, table, SNAPSHOTS[name])

        in_parallel([partial(build, name) for name in names])

    def staged(self, name: str) -> DataFrame:
        """Conformed rows: an entity's versions, latest events, or latest bridge rows."""
        if name in ENTITIES:
            return stage_entity(read_table(self.spark, self._table("snapshots", name)), ENTITIES[name])
        for bridge in BRIDGES:
            if name == bridge.raw:
                return stage_bridge(self.raw(name), ENTITIES[bridge.entity].key)
        return read_table(self.spark, self._table("clean", name))

    def create_staging_views(self) -> None:
        """The entity views; event and bridge rows are composed where they are used."""
        for name, entity in ENTITIES.items():
            names = {c: entity.renames.get(c, c) for c in entity.columns}
            lifecycle = {"date_added": "added_at", "date_removed": "removed_at"} if entity.lifecycle else {}
            names |= {**lifecycle, "date_modified": "modified_at"}
            select = ", ".join(f"`{source}` AS `{out}`" for source, out in names.items())
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self._table('staging', name)} AS SELECT scd_id, {select}, "
                "valid_from, valid_to, valid_to IS NULL AS is_current_record, scd_updated_at "
                f"FROM {self._table('snapshots', name)} WHERE date_deleted IS NULL"
            )

    def build_prep(self, window: RunWindow) -> None:
        """Latest events, their totals, and the prorated lines of the orders they touch."""
        self.proration.build(window)

    # Marts ------------------------------------------------------------------

    def build_marts(self, window: RunWindow, database: str) -> None:
        """Dimensions first: facts and bridges look their keys up in them."""
        in_parallel([
            partial(self._build_dates, database),
            *[partial(self.build_dimension, name, window, database) for name in ENTITIES],
        ])
        dims = self._dimensions(database)
        in_parallel([
            *self._fact_builds(window, database, dims),
            *[partial(self._build_bridge, bridge, window, database, dims) for bridge in BRIDGES],
        ])

    def _build_dates(self, database: str) -> None:
        replace_table(self.raw("date_dimension"), f"{database}.dim_date", DIM_DATE)

    def build_dimension(self, name: str, window: RunWindow, database: str) -> None:
        entity = ENTITIES[name]
        history, current = f"{database}.{HISTORY[name].name}", f"{database}.dim_{name}"
        versions = changed = history_dimension(self.staged(name), entity)
        existing, keys = self._existing(history), None
        if existing is not None:
            # Closing a version leaves its change time alone: take all versions of a touched key.
            # A deletion touches its key too, and shows only in the snapshot.
            touched = changed_in_run(
                self.spark, self._table("snapshots", name), "scd_updated_at", window, history, "updated_at", self.lookback_days)
            keys = materialise(touched.select(entity.key).distinct(), "touched-keys")
            changed = versions.join(keys, entity.key, "left_semi").select(*versions.columns)
        upsert(changed, history, HISTORY[name])
        if not entity.current:
            return
        if CURRENT[name].incremental:
            rows = changed_in_run(self.spark, history, "updated_at", window, current, "updated_at", self.lookback_days)
            upsert(current_rows(rows), current, CURRENT[name])
            if keys is not None:
                present = current_rows(read_table(self.spark, history)).select(entity.key)
                remove_keys(keys.join(present, entity.key, "left_anti"), current, CURRENT[name])
        else:
            replace_table(current_rows(read_table(self.spark, history)), current, CURRENT[name])

    def _dimensions(self, database: str) -> dict[str, DataFrame]:
        dims = {n: read_table(self.spark, f"{database}.{HISTORY[n].name}") for n in ENTITIES}
        return {**dims, "date": read_table(self.spark, f"{database}.dim_date")}

    def _fact_builds(
        self, window: RunWindow, database: str, dims: dict[str, DataFrame]
    ) -> list[Callable[[], None]]:
        prep = self._table("prep", PREP.name)

        def changed(table: str, fact: str, at: str, target_at: str) -> DataFrame:
            return changed_in_run(self.spark, table, at, window, f"{database}.{fact}", target_at, self.lookback_days)

        def touched_lines(fact: str, target_at: str) -> DataFrame:
            """All lines of the touched orders: a late line changes the shares of its whole order."""
            if not table_exists(self.spark, f"{database}.{fact}"):
                return read_table(self.spark, prep)
            orders = materialise(changed(prep, fact, "changed_at", target_at).select("transaction_id").distinct(), "fact-orders")
            return rows_with_keys(self.spark, prep, orders, ["transaction_id"])

        def line_fact(fact: str, plan: Callable[..., DataFrame]) -> None:
            upsert(plan(touched_lines(fact, "source_modified_at"), dims), f"{database}.{fact}", FACTS[fact])

        def transactions() -> None:
            rows = touched_lines("fct_transactions", "modified_at")
            upsert(facts.transactions(rows, dims), f"{database}.fct_transactions", FACTS["fct_transactions"])

        def payments() -> None:
            paid = changed(self._table("clean", "transaction_payments"), "fct_payments", "modified_at", "source_updated_at")
            upsert(facts.payments(paid, dims["payment_types"]), f"{database}.fct_payments", FACTS["fct_payments"])

        def discounts() -> None:
            off = changed(
                self._table("clean", "transaction_discounts"), "fct_discounts", "modified_at", "source_modified_at")
            batch = table_exists(self.spark, f"{database}.fct_discounts")
            lines, headers = self.staged("transaction_lines"), self.staged("transaction_headers")
            upsert(facts.discounts(off, lines, headers, dims, batch), f"{database}.fct_discounts",
                   FACTS["fct_discounts"])

        return [
            partial(line_fact, "fct_sales", facts.sales), partial(line_fact, "fct_returns", facts.returns),
            transactions, payments, discounts,
        ]

    def _build_bridge(
        self, bridge: Bridge, window: RunWindow, database: str, dims: dict[str, DataFrame]
    ) -> None:
        table = f"{database}.{bridge.mart}"
        rows = changed_rows(
            self.staged(bridge.raw), "modified_at", window, self._existing(table),
            "relationship_modified_at", self.lookback_days,
        )
        pairs = facts.version_bridge(
            rows, dims["products"], dims[bridge.entity], "product",
            ENTITIES[bridge.entity].singular, bridge.sk, self.bridges_by_start, keep_unmatched=True,
        )
        upsert(pairs, table, BRIDGE_TABLES[bridge.mart])

    # Runs -------------------------------------------------------------------

    def roles(self) -> Roles:
        return read_roles(self.spark, self.db("mart_blue"), self.db("mart_green"))

    def run(self, window: RunWindow, allow_unknown: bool = False, audit_source: bool = False) -> Roles:
        """Build all layers for a window, audit the marts (and, if asked, the source before), publish them."""
        self.build_clean(window)
        if audit_source:
            require_clean(self.source_report(), "source")
        self.build_snapshots()
        self.create_staging_views()
        self.build_prep(window)
        roles = self.roles()
        prepare_audit(self.spark, roles, MART_TABLES)
        self.build_marts(window, roles.audit)
        return audit_and_publish(self.spark, roles, self.db("live"), MART_AUDITS, allow_unknown)

    def backfill(self, first: date, end: date, allow_unknown: bool = False) -> None:
        """Days [first, end) in order: history of one day builds on the day before."""
        day = first
        while day < end:
            following = day + timedelta(days=1)
            self.run(RunWindow(day.isoformat(), following.isoformat()), allow_unknown)
            day = following
