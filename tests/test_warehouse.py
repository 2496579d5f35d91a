"""The whole pipeline on hand-made rows."""

import uuid
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from retail_rows import SCHEMAS, all_days, at, customer, discount, first_day, frame, header, line, second_day

from tidemark.operators.audit import AuditFailed
from tidemark.operators.incremental import RunWindow
from tidemark.plans.audits import source_audits
from tidemark.plans.entities import MART_TABLES
from tidemark.plans.publish import RoleError, Roles, prepare_audit, read_roles, set_status, table_names
from tidemark.plans.warehouse import Warehouse
from tidemark.sources.tables import read_table


def load(warehouse, source):
    for table in SCHEMAS:
        found = source.get(table, [])
        if found:
            warehouse.load_raw(table, frame(warehouse.spark, table, found))


@pytest.fixture(scope="module")
def twice(spark):
    """Two runs: the first day in full, then the second day as an increment."""
    warehouse = Warehouse(spark, "w" + uuid.uuid4().hex[:8])
    warehouse.create()
    warehouse.load_raw("date_dimension", all_days(spark))
    load(warehouse, first_day())
    first = warehouse.run(RunWindow("2025-01-01", "2025-01-03"))
    snapshot = {t: rows(spark.table(f"{first.live}.{t}").drop("part_of_line_created_at"))
                for t in ("fct_transactions",)}
    load(warehouse, second_day())
    second = warehouse.run(RunWindow("2025-01-04", "2025-01-05"))
    return warehouse, first, second, snapshot


@pytest.fixture(scope="module")
def once(spark):
    """One full run over the rows of both days."""
    warehouse = Warehouse(spark, "w" + uuid.uuid4().hex[:8])
    warehouse.create()
    warehouse.load_raw("date_dimension", all_days(spark))
    load(warehouse, first_day())
    load(warehouse, second_day())
    # The clean rows hold only the last change of a customer, so earlier sales find no version.
    warehouse.run(RunWindow(), allow_unknown=True)
    return warehouse


def live(warehouse, table, *columns):
    df = warehouse.spark.table(f"{warehouse.db('live')}.live_{table}")
    return rows(df, *columns)


def test_all_marts_are_published(twice):
    warehouse, _, second, _ = twice
    assert set(table_names(warehouse.spark, second.live)) == set(MART_TABLES)
    views = set(table_names(warehouse.spark, warehouse.db("live")))
    assert views == {f"live_{t}" for t in MART_TABLES}


def test_roles_swap_with_each_run(twice):
    warehouse, first, second, _ = twice
    assert first == Roles(warehouse.db("mart_green"), warehouse.db("mart_blue"))
    assert second == Roles(warehouse.db("mart_blue"), warehouse.db("mart_green"))


def test_stale_side_is_untouched_by_the_second_run(twice):
    warehouse, first, _, snapshot = twice
    stale = warehouse.spark.table(f"{first.live}.fct_transactions").drop("part_of_line_created_at")
    assert rows(stale) == snapshot["fct_transactions"]


@pytest.mark.parametrize("table", ["fct_sales", "fct_returns", "fct_transactions", "fct_payments", "fct_discounts"])
def test_increment_equals_full_run_up_to_history(twice, once, table):
    """A full run sees only the latest customer and product rows, so keys differ; measures do not."""
    columns = [c for c in once.spark.table(f"{once.db('live')}.live_{table}").columns if not c.endswith("_sk")]
    assert live(twice[0], table, *columns) == live(once, table, *columns)


def test_proration_of_the_corrected_order(twice):
    """Order 1 after the correction: lines net 50 and 10, order discount 9, tax 24."""
    got = live(twice[0], "fct_sales", "transaction_line_id", "prorated_discount_amount", "prorated_tax_amount",
               "net_amount")
    values = {r[0]: r[1:] for r in got}
    assert values[11] == (Decimal("7.5000"), Decimal("20.0000"), Decimal("62.5000"))
    assert values[12] == (Decimal("1.5000"), Decimal("4.0000"), Decimal("12.5000"))
    # Order 2 nets to zero: its tax vanishes.
    assert values[21] == (Decimal("0.0000"), Decimal("0.0000"), Decimal("0.0000"))


def test_returns_count_negative(twice):
    got = live(twice[0], "fct_transactions", "transaction_id", "net_amount", "total_amount", "total_amount_tax_once")
    values = {r[0]: r[1:] for r in got}
    assert values[3] == (Decimal("-33.0000"), Decimal("-36.0000"), Decimal("-33.0000"))


def test_history_dimension_has_both_versions(twice):
    got = live(twice[0], "dim_customers_history", "customer_id", "province", "valid_from_ts", "valid_to_ts")
    assert [r for r in got if r[0] == 1] == [
        (1, "BC", at("01", 9), at("04", 9)), (1, "ON", at("04", 9), None)]
    assert live(twice[0], "dim_customers", "customer_id", "province") == [(1, "ON"), (2, "BC"), (3, "BC")]


def test_facts_point_to_the_version_of_their_time(twice):
    warehouse = twice[0]
    sk = {(r[0], r[1]): r[2] for r in live(warehouse, "dim_products_history", "product_id", "product_name", "product_sk")}
    sales = {r[0]: r[1] for r in live(warehouse, "fct_sales", "transaction_line_id", "product_sk")}
    assert sales[11] == sk[(1, "Game 1")]
    assert sales[41] == sk[(1, "Game 1b")]


def test_bridge_keeps_the_end_of_a_relation(twice):
    got = live(twice[0], "brg_products_categories_history", "relationship_ended_at", "relationship_end_reason")
    assert (at("04"), "removed") in got


def test_running_a_window_again_changes_nothing(twice, spark):
    warehouse = twice[0]
    tables = ("fct_sales", "fct_transactions", "dim_customers_history", "brg_products_categories_history")
    before = {t: live(warehouse, t) for t in tables}
    database = warehouse.roles().audit
    prepare_audit(spark, warehouse.roles(), MART_TABLES)
    warehouse.build_marts(RunWindow("2025-01-04", "2025-01-05"), database)
    after = {t: rows(read_table(spark, f"{database}.{t}")) for t in tables}
    assert after == before
    assert {t: live(warehouse, t) for t in tables} == before


def test_two_live_databases_are_refused(spark, once):
    blue, green = once.db("mart_blue"), once.db("mart_green")
    roles = once.roles()
    set_status(spark, roles.audit, "live")
    with pytest.raises(RoleError):
        read_roles(spark, blue, green)
    set_status(spark, roles.audit, "audit")
    assert once.roles() == roles


def test_staging_view_shows_undeleted_versions(once):
    view = once.spark.table(f"{once.db('staging')}.customers")
    assert "customer_status" in view.columns and "registered_at" in view.columns
    assert view.filter(F.col("is_current_record")).count() == 3


def test_failed_audit_moves_nothing(twice, spark):
    """A sale of an unknown customer: its '-1' key has no parent, so nothing is published."""
    warehouse = twice[0]
    roles, before = warehouse.roles(), live(warehouse, "fct_sales")
    warehouse.load_raw("transaction_headers", frame(spark, "transaction_headers", [header(9, day="06", customer=99)]))
    warehouse.load_raw("transaction_lines", frame(spark, "transaction_lines", [line(91, 9, 10, day="06")]))
    with pytest.raises(AuditFailed) as error:
        warehouse.run(RunWindow("2025-01-06", "2025-01-07"))
    assert "fct_sales.customer_sk relationships: 1" in error.value.failures
    assert warehouse.roles() == roles
    assert live(warehouse, "fct_sales") == before


def test_corrections_and_deletes_reach_the_marts(spark):
    """Long after their lines: a tax, then a discount of an order change, then a customer is deleted."""
    warehouse = Warehouse(spark, "w" + uuid.uuid4().hex[:8])
    warehouse.create()
    warehouse.load_raw("date_dimension", all_days(spark))
    load(warehouse, first_day())
    warehouse.run(RunWindow("2025-01-01", "2025-01-03"))

    load(warehouse, {"transaction_headers": [header(1, tax=48) | {"date_modified": at("15")}]})
    warehouse.run(RunWindow("2025-01-15", "2025-01-16"))
    taxes = [r[1] for r in live(warehouse, "fct_sales", "transaction_id", "prorated_tax_amount") if r[0] == 1]
    assert sum(taxes) == 48
    totals = {r[0]: r[1:] for r in live(warehouse, "fct_transactions", "transaction_id", "total_tax_amount", "total_discount_amount")}
    assert totals[1] == (48, 19)

    load(warehouse, {
        "transaction_discounts": [discount(2, 18, order=1) | {"date_modified": at("22")},
                                  discount(3, 15, line_id=21) | {"date_modified": at("22")}],
        "customers": [customer(2, "22", date_deleted=at("22", 9))],
    })
    warehouse.run(RunWindow("2025-01-22", "2025-01-23"))
    totals = {r[0]: r[1:] for r in live(warehouse, "fct_transactions", "transaction_id", "total_tax_amount", "total_discount_amount")}
    assert totals[1] == (48, 28)
    assert totals[2] == (6, 15)
    history = live(warehouse, "dim_customers_history", "customer_id", "valid_to_ts", "is_current_record")
    assert history == [(1, None, True), (2, at("22", 9), False)]
    assert live(warehouse, "dim_customers", "customer_id") == [(1,)]


def test_source_report_counts_for_every_loaded_table(once):
    report = {(r.table_name, r.check_name, r.column_name): r.violations for r in once.source_report().collect()}
    loaded = {t for t in source_audits() if once._existing(once._table("raw", t)) is not None}
    assert {t for t, _, _ in report} == loaded and "transaction_lines" in loaded
    assert report["transaction_lines", "relationships", "transaction_id"] == 0
    assert report["customers", "not_null", "email"] == 0 and report["customers", "check", "gender"] == 0
