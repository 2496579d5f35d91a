"""Fast checks of bounds, specs, keys and audits."""

import uuid
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.dates import window_bounds
from tidemark.functions.keys import uuid_v5
from tidemark.operators import audit
from tidemark.plans.audits import audit_sources
from tidemark.plans.oracle import oracle_sql
from tidemark.plans.queries import REGISTRY
from tidemark.sources.extract import folder_of_run, lake_folder
from tidemark.sources.specs import EXTRACTS, LOADS, ExtractSpec, FieldSpec, LoadSpec
from tidemark.sources.tables import TableSpec, read_table, seed_if_empty, upsert


@pytest.mark.parametrize("key, grain, start, end", [
    ("2025-03-01-07:00", "hourly", datetime(2025, 3, 1, 7), datetime(2025, 3, 1, 8)),
    ("2025-03-01", "daily", datetime(2025, 3, 1), datetime(2025, 3, 2)),
    ("2025-03-01", "weekly", datetime(2025, 2, 24), datetime(2025, 3, 3)),
    ("2025-12-31", "monthly", datetime(2025, 12, 1), datetime(2026, 1, 1)),
])
def test_window_bounds(key, grain, start, end):
    assert window_bounds(key, grain) == (start, end)


def test_bad_specs_are_refused():
    for broken in (
        lambda: window_bounds("2025-01-01", "yearly"), lambda: ExtractSpec("a b"),
        lambda: ExtractSpec("t", columns=("1x",)), lambda: ExtractSpec("t", layout="hourly"),
        lambda: LoadSpec("t", expiration_days=366), lambda: LoadSpec("t", partition_type="WEEK"),
        lambda: FieldSpec("f", mode="MAYBE"),
    ):
        with pytest.raises(ValueError):
            broken()


def test_ingest_covers_all_tables():
    assert (len(EXTRACTS), len(LOADS)) == (19, 20)


def test_week_folder_is_below_its_iso_year():
    folder = lake_folder("lake", ExtractSpec("t", grain="weekly"), datetime(2024, 12, 30))
    assert folder == "lake/t/year=2025/week=01/run=1230"


def test_uuid_v5_is_the_standard_one(spark):
    got = spark.range(50).select("id", uuid_v5(uuid.NAMESPACE_DNS, "id").alias("u")).collect()
    assert all(r.u == str(uuid.uuid5(uuid.NAMESPACE_DNS, str(r.id))) for r in got)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(oracle_sql())


def test_audit_counts_each_kind(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (None, "-1"), (2, None)], "k int, p string")
    parents = {"parents": spark.createDataFrame([("a",)], "p string")}
    spec = audit.TableAudit(("k",), ("k",), (audit.Relationship("p", "parents", "p"),), {"small": F.col("k") < 2})
    found = {r.check_name: r.violations for r in audit.audit_table(child, spec, parents).collect()}
    assert found == {"not_null": 1, "check": 1, "unique": 1, "relationships": 2}
    with pytest.raises(audit.AuditFailed):
        audit.require_clean(audit.audit_table(child, spec, parents))


def test_upsert_moves_a_key_and_keeps_newer_rows(spark, database):
    table, spec = f"{database}.t", TableSpec("t", ("k",), "day", "DAY", updated_at="changed")
    schema = "k int, day timestamp, changed timestamp, v string"

    def batch(*found):
        return spark.createDataFrame([(k, datetime(2025, 1, d), datetime(2025, 1, c), v) for k, d, c, v in found], schema)

    upsert(batch((1, 1, 1, "a"), (2, 2, 2, "b")), table, spec)
    upsert(batch((1, 3, 3, "moved"), (2, 2, 1, "late"), (3, 2, 2, "new")), table, spec)
    assert rows(read_table(spark, table), "k", "v") == [(1, "moved"), (2, "b"), (3, "new")]
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert parts == {"part_of_day=2025-01-02", "part_of_day=2025-01-03"}
    with pytest.raises(ValueError):
        upsert(batch((1, 1, 1, "a")).withColumn("extra", F.lit(1)), table, spec)


def test_seed_only_when_empty(spark, database):
    table, spec = f"{database}.seed", TableSpec("seed", ("k",))
    rows_in = spark.createDataFrame([(1, "a")], "k int, v string")
    assert seed_if_empty(rows_in, table, spec)
    assert not seed_if_empty(rows_in, table, spec)
    assert spark.table(table).count() == 1


def test_missing_run_is_an_error(spark, tmp_path):
    from tidemark.sources.extract import Extracted, record_run

    record_run(spark, str(tmp_path), Extracted("t", "2025-01-01", "somewhere", 0))
    for key in ("2025-01-01", "2025-01-02"):
        with pytest.raises(LookupError):
            folder_of_run(spark, str(tmp_path), "t", key)


def test_fixed_price_above_the_unit_price_is_a_negative_discount(spark):
    from tidemark.functions.measures import discount_amount

    rows = spark.createDataFrame([("FIXED", 5, 9, 2), ("FIXED", 5, -1, 2), ("FLAT", 5, 9, 2), ("NONE", 5, 1, 2)], "pool string, price int, value int, quantity int")
    got = [float(r[0]) for r in rows.select(discount_amount("pool", "price", "value", "quantity")).collect()]
    assert got == [-8.0, 10.0, 10.0, 0.0]


def test_backfill_twice_is_once_and_fits_single_runs(spark, tmp_path):
    from tidemark.sources.extract import extract_range, extract_run, record_run

    found = [(i, datetime(2025, 1, 30 if i < 3 else 31, i)) for i in range(6)] + [(9, datetime(2025, 2, 1, 5))]
    df = spark.createDataFrame(found, "k int, t timestamp")
    base, manifest = str(tmp_path / "lake"), str(tmp_path / "manifest")
    for layout in ("daily", "monthly"):
        spec = ExtractSpec(f"t_{layout}", "t", "daily", layout)
        record_run(spark, manifest, extract_run(df, spec, "2025-01-31", base))
        for _ in range(2):
            folder = extract_range(df, spec, datetime(2025, 1, 30), datetime(2025, 2, 2), base, manifest)
        extract_run(df, spec, "2025-02-01", base)
        assert rows(spark.read.parquet(folder), "k", "t") == sorted(found, key=repr)
        run = folder_of_run(spark, manifest, spec.table, "2025-01-30")
        assert run == lake_folder(base, spec, datetime(2025, 1, 30))
        assert rows(spark.read.parquet(run), "k") == [(0,), (1,), (2,)]
    with pytest.raises(ValueError):
        extract_range(df, ExtractSpec("t", "t", "daily"), datetime(2025, 1, 30, 4), datetime(2025, 2, 2), base)


def test_discount_finds_its_customer_by_either_path(spark):
    from tidemark.plans.facts import discount_keys

    off = spark.createDataFrame([(1, 11, 2), (2, 12, 2), (3, None, 1), (4, 11, None)],
                                "d int, transaction_line_id long, transaction_id long")
    lines = spark.createDataFrame([(11, 7, 1), (12, 1, 1)], "transaction_line_id long, transaction_id long, product_id int")
    headers = spark.createDataFrame([(1, 100), (2, 200)], "transaction_id long, customer_id long")
    for reduce in (True, False):
        got = rows(discount_keys(off, lines, headers, reduce), "d", "product_id", "customer_id")
        assert got == [(1, 1, 200), (2, 1, 100), (3, None, 100), (4, 1, None)]


def test_unknown_order_pool_is_an_error(spark):
    from tidemark.plans.promotions import order_totals

    lines = spark.createDataFrame([(1, 10)], "transaction_id int, gross_line_total int")
    none = spark.createDataFrame([], "transaction_id int, discount_amount int")
    off = spark.createDataFrame([(1, "BOGO", 5)], "transaction_id int, discount_pool string, discount_value int")
    assert order_totals(lines, none, off.limit(0)).count() == 1
    with pytest.raises(Exception, match="unknown pool"):
        order_totals(lines, none, off).collect()


def test_bridge_keys_keep_unmatched_pairs(spark):
    from tidemark.plans.facts import version_bridge

    at = datetime(2025, 1, 1)
    pairs = spark.createDataFrame([(i, 1, at, at, None, None) for i in (1, 2, 3)],
                                  "a_id int, product_id int, added_at timestamp, modified_at timestamp, "
                                  "removed_at timestamp, removal_reason string")
    sides = [spark.createDataFrame([], f"{n}_id int, {n}_sk string, valid_from_ts timestamp, valid_to_ts timestamp")
             for n in ("product", "a")]
    got = version_bridge(pairs, *sides, "product", "a", "sk", keep_unmatched=True)
    assert got.select("sk").distinct().count() == 3


def test_negative_amounts_fail_the_job(spark):
    lines = spark.createDataFrame([(1, 2.5), (2, None), (3, 0.0)], "id int, amount double")
    assert rows(audit.reject_negative(lines, "amount")) == [(1, 2.5), (2, None), (3, 0.0)]
    with pytest.raises(Exception, match="negative amount: -0.5"):
        audit.reject_negative(lines.union(spark.sql("SELECT 4, -0.5D")), "amount").collect()


def test_source_audits_name_the_table_and_need_parents(spark):
    columns = "payment_type_id int, payment_type_uuid string, type_name string, date_added timestamp"
    types = spark.sql("SELECT 1 a, 'u' b, 'Card' c, now() d UNION ALL SELECT 2, null, 'Card', now()").toDF(*[c.split()[0] for c in columns.split(", ")])
    report = {(r.table_name, r.check_name, r.column_name): r.violations for r in audit_sources({"payment_types": types}).collect()}
    assert report["payment_types", "unique", "type_name"] == 1 and report["payment_types", "not_null", "payment_type_uuid"] == 1
    assert sum(report.values()) == 2
    empty = audit_sources({"payment_types": types.limit(0)}).collect()
    assert len(empty) == len(report) and not any(r.violations for r in empty)
    with pytest.raises(ValueError, match="transaction_headers"):
        audit_sources({"transaction_payments": types, "payment_types": types})
