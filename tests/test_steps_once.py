"""Steps over large tables run once: what queries hand to writes and audits, and how an upsert finds its partitions."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_tables import SPEC, batch

from tidemark.plans import queries
from tidemark.sources import tables
from tidemark.sources.tables import TableSpec, read_table, upsert

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


class Seen(Exception):
    pass


def handed_over(spark, monkeypatch, place, name, query, position=0):
    """The argument that a query hands to a function first."""
    found = []

    def take(*args, **_):
        found.append(args[position])
        raise Seen

    with monkeypatch.context() as broken:
        broken.setattr(place, name, take)
        with pytest.raises(Seen):
            queries.REGISTRY[query](spark, FOLDER)
    return found[0]


@pytest.mark.parametrize("query", ["wap_publish", "revert_table"])
def test_prorated_lines_are_written_before_they_are_published(spark, monkeypatch, query):
    plan = plan_of(handed_over(spark, monkeypatch, tables, "upsert", query))
    assert "Window" not in plan and "Join" not in plan, plan


def test_upsert_alone_finds_the_latest_lines(spark, monkeypatch):
    assert "Window" not in plan_of(handed_over(spark, monkeypatch, tables, "upsert", "upsert_result"))


def test_audited_tables_are_written_before_each_constraint_reads_them(spark, monkeypatch):
    audited = handed_over(spark, monkeypatch, queries, "audit_sources", "audit_source_tables")
    for name in ("transaction_lines", "transaction_discounts"):
        assert "Window" not in plan_of(audited[name]), name


def test_customer_feed_is_written_before_it_is_loaded(spark, monkeypatch):
    assert "Window" not in plan_of(handed_over(spark, monkeypatch, queries.Warehouse, "load_raw", "history_publish_after_delete", 2))


def test_ties_of_a_spec_settle_equal_times(spark, database):
    spec = TableSpec("t", ("k",), "day", "DAY", updated_at="changed", ties=("v",))
    upsert(batch(spark, (1, 5, 9, "a"), (1, 2, 9, "b"), (2, 3, 8, "z")), f"{database}.t", spec)
    assert rows(read_table(spark, f"{database}.t"), "k", "v") == [(1, "b"), (2, "z")]


def test_large_batch_is_not_probed_for_and_small_one_is(spark, database):
    table = f"{database}.t"
    upsert(batch(spark, *[(k, k, 10, "a") for k in range(20)]), table, SPEC)
    state = tables.catch_up(spark, table)[2]
    assert len(tables.parts_of_keys(spark, state, batch(spark, (3, 3, 11, "b")), ["k"])) < 20
    assert len(tables.parts_of_keys(spark, state, batch(spark, *[(k, 0, 11, "b") for k in range(5)]), ["k"])) == 20


def test_large_batch_moves_keys_and_leaves_older_rows_out(spark, database):
    table = f"{database}.t"
    upsert(batch(spark, *[(k, k, 10, "a") for k in range(8)]), table, SPEC)
    before = tables.part_locations(spark, table)
    upsert(batch(spark, (0, 5, 11, "moved"), (1, 1, 9, "old"), (2, 2, 10, "equal"), (30, 6, 9, "new"), (None, 3, 9, "none")), table, SPEC)
    assert rows(read_table(spark, table).filter("v <> 'a'"), "k", "v") == [(0, "moved"), (2, "equal"), (30, "new"), (None, "none")]
    assert read_table(spark, table).count() == 10
    after = tables.part_locations(spark, table)
    days = {1: "2025-01-01", 3: "2025-01-03", 4: "2025-01-04", 6: "2025-01-06", 7: "2025-01-07"}
    assert {k for k in before if before[k] != after.get(k)} == {days[n] for n in (1, 3, 4, 6, 7)}
    # Rows without `newer_wins` replace whatever is there.
    upsert(batch(spark, (7, 0, 1, "older")), table, SPEC, newer_wins=False)
    assert rows(read_table(spark, table).filter("k = 7"), "k", "v") == [(7, "older")]


def test_one_per_key_writes_the_rows_as_they_are(spark, database, monkeypatch):
    monkeypatch.setattr(tables, "latest_per_key", lambda *_: pytest.fail("the latest rows were looked for"))
    upsert(batch(spark, (1, 1, 1, "a"), (2, 1, 1, "b")), f"{database}.t", SPEC, one_per_key=True)
    upsert(batch(spark, (1, 2, 2, "c")), f"{database}.t", SPEC, one_per_key=True)
    assert rows(read_table(spark, f"{database}.t").select("k", F.col("v"))) == [(1, "c"), (2, "b")]


def test_each_change_of_an_event_table_is_read_once(spark, monkeypatch):
    from tidemark.plans import proration

    read, apart = [], proration.versions_apart

    def counted(session, table, version):
        read.append((table, version))
        return apart(session, table, version)

    monkeypatch.setattr(proration, "versions_apart", counted)
    assert queries.REGISTRY["incremental_facts"](spark, FOLDER).count() > 0
    assert len(read) == len(set(read)), read


def test_first_load_counts_every_row_without_a_shuffle(spark, database):
    from tidemark.plans.proration import Proration
    from tidemark.sources.tables import table_version

    table = f"{database}.transaction_lines"
    upsert(batch(spark, (1, 1, 1, "a"), (2, 2, 1, "b")), table, SPEC)
    work = Proration(spark, str, lambda name: f"{database}.{name}", str)
    found = work._changed({"transaction_lines": 0}, {"transaction_lines": table_version(spark, table)})["transaction_lines"]
    assert rows(found, "k", "_sign") == [(1, 1), (2, 1)]
    assert "Aggregate" not in plan_of(found)
