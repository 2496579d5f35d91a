"""The commit log of tables and its indexes: pruning, key filters, versions, clean-up."""

import re
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.keyindex import key_filters, parts_that_may_hold, size_class
from tidemark.sources import store, tables
from tidemark.sources.tables import ConcurrentWrite, TableSpec, append_rows, clone_table, read_changed, read_table, upsert

SPEC = TableSpec("t", ("k",), "day", "DAY", updated_at="changed")
COLUMNS = "k long, day timestamp, changed timestamp, v string"


def day(n, hour=0):
    return datetime(2025, 1, 1, hour) + timedelta(days=n)


def batch(spark, *found):
    """(key, day, day of change, value)"""
    return spark.createDataFrame([(k, d if d is None else day(d), c if c is None else day(c, 5), v) for k, d, c, v in found], COLUMNS)


@pytest.fixture(scope="module")
def days(spark):
    """A key per day on 100 days, each changed the day after; key 7 very late."""
    name = "t_" + uuid.uuid4().hex[:12]
    tables.create_database(spark, name)
    upsert(batch(spark, *[(k, k, 300 if k == 7 else k + 1, "a") for k in range(100)]), f"{name}.days", SPEC)
    return f"{name}.days"


def test_filters_name_every_partition_of_a_key(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3).cast("string").alias("p"))
    classes = {"0": size_class(1000), "1": 0, "2": size_class(10)}
    filters = key_filters(df, ["id"], F.col("p"), classes)
    for k in (0, 301, 2999):
        found = {r.part for r in parts_that_may_hold(filters, df.filter(F.col("id") == k), ["id"], classes.values()).collect()}
        assert str(k % 3) in found
    good = key_filters(df, ["id"], F.col("p"), {p: size_class(1000) for p in "012"})
    probes = spark.range(10_000, 12_000)
    assert parts_that_may_hold(good, probes.limit(20), ["id"], [size_class(1000)]).count() <= 1
    assert parts_that_may_hold(good, probes.limit(0), ["id"], [size_class(1000)]).count() == 0


def test_window_opens_only_partitions_changed_in_it(spark, database, days):
    table = f"{database}.t"
    clone_table(spark, days, table, SPEC)
    got = read_changed(spark, table, "changed", day(300), day(301))
    assert rows(got, "k") == [(7,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*part_of_day#\d+ = 2025-01-08", plan), plan
    assert len(got.inputFiles()) == 1
    assert rows(read_changed(spark, table, "changed", day(50), day(52)), "k") == [(49,), (50,)]
    assert read_changed(spark, table, "changed", day(400)).inputFiles() == []
    assert read_changed(spark, table, "changed", None).count() == 100
    # A column without bounds is filtered only.
    assert rows(read_changed(spark, table, "day", day(3), day(5)), "k") == [(3,), (4,)]
    assert tables.last_change(spark, table, "changed") == day(300, 5).replace(tzinfo=timezone.utc)
    assert tables.last_change(spark, table, "day") == day(99).replace(tzinfo=timezone.utc)


def test_bounds_follow_upserts_and_null_times(spark, database, days):
    table = f"{database}.t"
    clone_table(spark, days, table, SPEC)
    upsert(batch(spark, (3, 3, 200, "b"), (200, 3, None, "c"), (201, None, 200, "d")), table, SPEC)
    assert rows(read_changed(spark, table, "changed", day(200), day(201)), "k") == [(201,), (3,)]
    upsert(batch(spark, (201, 60, 210, "e")), table, SPEC)
    assert rows(read_changed(spark, table, "changed", day(200), day(220)), "k", "v") == [(201, "e"), (3, "b")]


def test_upsert_opens_only_partitions_of_its_keys(spark, database, days):
    table = f"{database}.t"
    clone_table(spark, days, table, SPEC)
    _, _, state = tables.catch_up(spark, table)
    moved = batch(spark, (42, 77, 301, "moved"), (1000, 5, 301, "new"))
    opened = set(tables.parts_of_keys(spark, state, moved, ["k"]))
    assert "2025-02-12" in opened and len(opened) <= 3
    before = tables.part_locations(spark, table)
    upsert(moved, table, SPEC)
    after = tables.part_locations(spark, table)
    assert {k for k in before if before[k] != after.get(k)} == {"2025-02-12", "2025-03-19", "2025-01-06"}
    assert rows(read_table(spark, table).filter("k in (42, 77, 1000, 5)"), "k", "v") == [(1000, "new"), (42, "moved"), (5, "a"), (77, "a")]
    assert read_table(spark, table).count() == 101
    # The filters of superseded partitions no longer count.
    assert "2025-02-12" not in tables.parts_of_keys(spark, tables.catch_up(spark, table)[2], moved, ["k"])
    tables.remove_keys(moved.select("k"), table, SPEC)
    assert read_table(spark, table).count() == 99


def test_of_two_writers_the_second_fails(spark, database, days):
    table = f"{database}.t"
    clone_table(spark, days, table, SPEC)
    seen = tables.catch_up(spark, table)
    upsert(batch(spark, (1, 1, 310, "first")), table, SPEC)
    late = tables._write(batch(spark, (1, 1, 311, "second")), SPEC, tables._new_folder(spark, table))
    with pytest.raises(ConcurrentWrite):
        tables._commit(spark, table, seen, "upsert", late)
    assert rows(read_table(spark, table).filter("k = 1"), "v") == [("first",)]
    upsert(batch(spark, (1, 1, 311, "second")), table, SPEC)
    assert rows(read_table(spark, table).filter("k = 1"), "v") == [("second",)]
    assert [o for _, _, o in tables.table_log(spark, table)] == ["clone", "upsert", "upsert"]


def test_writer_that_dies_before_the_catalog_is_caught_up(spark, database, days, monkeypatch):
    table = f"{database}.t"
    clone_table(spark, days, table, SPEC)
    with monkeypatch.context() as broken:
        broken.setattr(tables, "_point", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            upsert(batch(spark, (1, 1, 310, "b")), table, SPEC)
    assert rows(read_table(spark, table).filter("k = 1"), "v") == [("a",)]
    upsert(batch(spark, (2, 2, 310, "c")), table, SPEC)
    assert rows(read_table(spark, table).filter("k in (1, 2)"), "k", "v") == [(1, "b"), (2, "c")]


def test_revert_to_any_kept_version(spark, database, monkeypatch):
    monkeypatch.setattr("tidemark.sources.commits.FULL_EVERY", 3)
    table, times = f"{database}.t", []
    for n in range(6):
        upsert(batch(spark, (1, 1, n, f"v{n}"), (n + 10, 2, n, "x")), table, SPEC)
        times.append(datetime.now(timezone.utc))
    for n in (0, 4, 2):
        tables.revert_table(spark, table, SPEC, times[n])
        assert rows(read_table(spark, table).filter("k = 1"), "v") == [(f"v{n}",)]
        assert read_table(spark, table).count() == n + 2
    with pytest.raises(LookupError):
        tables.revert_table(spark, table, SPEC, times[0] - timedelta(days=1))


def test_vacuum_frees_what_no_kept_version_uses(spark, database, monkeypatch):
    monkeypatch.setattr(tables, "table_root", lambda s, root=tables.table_root(spark) + "-" + database: root)
    one, two = f"{database}.one", f"{database}.two"
    upsert(batch(spark, (1, 1, 1, "a"), (2, 2, 1, "a")), one, SPEC)
    clone_table(spark, one, two, SPEC)
    upsert(batch(spark, (1, 1, 2, "b")), one, SPEC)
    middle = datetime.now(timezone.utc)
    upsert(batch(spark, (1, 1, 3, "c")), one, SPEC)
    spark.sql(f"CREATE VIEW {database}.seen AS SELECT * FROM {one}")
    unused = tables._new_folder(spark, "abandoned")
    batch(spark, (9, 9, 9, "z")).write.parquet(unused)
    later = datetime.now(timezone.utc) + timedelta(days=30)
    # Young enough to be somebody's work, and all versions are young enough to be kept.
    assert tables.vacuum(spark, timedelta(days=40), later) == []
    freed = tables.vacuum(spark, timedelta(days=1), later)
    assert any(p.endswith(unused.rsplit("/", 1)[1]) for p in freed) and len(freed) == 2
    assert rows(read_table(spark, one), "k", "v") == [(1, "c"), (2, "a")]
    assert rows(read_table(spark, two), "k", "v") == [(1, "a"), (2, "a")]
    with pytest.raises(LookupError):
        tables.revert_table(spark, one, SPEC, middle)
    upsert(batch(spark, (2, 3, 4, "d")), two, SPEC)
    assert rows(read_table(spark, two), "k", "v") == [(1, "a"), (2, "d")]
    assert tables.vacuum(spark, timedelta(days=1), later + timedelta(days=1)) != freed


def test_expired_partitions_are_freed(spark, database, monkeypatch):
    monkeypatch.setattr(tables, "table_root", lambda s, root=tables.table_root(spark) + "-" + database: root)
    table = f"{database}.t"
    for k in range(4):
        upsert(batch(spark, (k, 100 * k, k, "a")), table, SPEC)
    gone = tables.part_locations(spark, table)["2025-01-01"]
    assert tables.expire_partitions(spark, table, SPEC, 30, (day(150)).date()) == ["2025-01-01", "2025-04-11"]
    assert store.entries(spark, gone)
    tables.vacuum(spark, timedelta(days=1), datetime.now(timezone.utc) + timedelta(days=9))
    assert not store.entries(spark, gone) and read_table(spark, table).count() == 2


def test_loads_show_whole_and_once(spark, database):
    table, spec = f"{database}.raw", TableSpec("raw", ("k",), "day", "MONTH", bounds=("changed",))
    for n in range(5):
        append_rows(batch(spark, (n, 1, n, "a"), (n, 40, n, "a")), table, spec, f"run-{n}")
    append_rows(batch(spark, (0, 1, 0, "a")), table, spec, "run-0")
    assert read_table(spark, table).count() == 10
    one = read_changed(spark, table, "changed", day(4), day(5))
    assert rows(one, "k") == [(4,), (4,)] and len(one.inputFiles()) == 2
    assert tables.compact(spark, table, spec) == []
    assert tables.compact(spark, table, spec, 4) == ["2025-01", "2025-02"]
    assert read_table(spark, table).count() == 10 and len(tables.part_locations(spark, table)) == 2
    assert rows(read_changed(spark, table, "changed", day(4), day(5)), "k") == [(4,), (4,)]
    with pytest.raises(ValueError):
        append_rows(batch(spark, (0, 1, 0, "a")).drop("v"), table, spec)


def test_scratch_is_swept_by_age(spark):
    from tidemark.session import materialise

    kept = materialise(spark.range(3), "young")
    assert not any("young-" in p for p in tables.sweep_scratch(spark, timedelta(hours=1)))
    assert kept.count() == 3
