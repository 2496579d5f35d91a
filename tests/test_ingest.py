"""The ingest job over several tables: waves, death half way, repeats."""

from datetime import date, datetime

import pytest
from conftest import rows

from tidemark.sources import ingest
from tidemark.sources.specs import ExtractSpec, FieldSpec, LoadSpec
from tidemark.sources.tables import TableSpec, part_locations, read_table


def test_waves():
    needs = {"lines": {"headers", "products"}, "headers": {"customers"}, "customers": {"customers", "elsewhere"}}
    assert ingest.in_waves(["lines", "headers", "products", "customers"], needs) == [["customers", "products"], ["headers"], ["lines"]]
    with pytest.raises(ValueError):
        ingest.in_waves("ab", {"a": {"b"}, "b": {"a"}})


def test_a_run_that_dies_goes_on_where_it_stopped(spark, database, tmp_path):
    asked = []

    def source(name, broken=""):
        asked.append(name)
        if name == broken:
            raise RuntimeError("gone")
        at = [datetime(2025, 1, 3, h) for h in range(3)] if name != "empty" else [datetime(2025, 1, 9)]
        return spark.createDataFrame([(k, t) for k, t in enumerate(at)], "k int, date_modified timestamp")

    names = ["a", "b", "c", "empty"]
    loads = {n: (LoadSpec(n, (FieldSpec("k", "bigint", "REQUIRED"), FieldSpec("date_modified", "timestamp")) if n == "b" else (), expiration_days=30),
                 TableSpec(n, ("k",), "date_modified")) for n in names}
    given = ([ExtractSpec(n) for n in names], loads, "2025-01-03", str(tmp_path / "lake"), str(tmp_path / "manifest"), database, {"c": {"a", "b"}})
    with pytest.raises(RuntimeError):
        ingest.ingest_run(spark, lambda n: source(n, "c"), *given, threads=1)
    assert set(ingest.recorded(spark, str(tmp_path / "manifest"), "2025-01-03")) == {"a", "b", "empty"}
    asked.clear()
    assert ingest.ingest_run(spark, source, *given) == {"a": 3, "b": 3, "c": 3, "empty": 0}
    assert asked == ["c"]
    assert ingest.ingest_run(spark, source, *given) == {"a": 3, "b": 3, "c": 3, "empty": 0}
    for name in "abc":
        assert rows(read_table(spark, f"{database}.{name}"), "k") == [(0,), (1,), (2,)]
    assert dict(read_table(spark, f"{database}.b").dtypes)["k"] == "bigint"
    assert not spark.catalog.tableExists(f"{database}.empty")
    del loads["empty"]
    assert ingest.expire(spark, loads, database, date(2025, 3, 1))["a"] == ["2025-01-03/run-2025-01-03"]
    assert part_locations(spark, f"{database}.a") == {}
