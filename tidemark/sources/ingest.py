"""One run over all ingest specs: extract, record, load, each table in turn after those it refers to.

A run writes each table to a folder of its own attempt and records it in the
manifest, a file for each table and run: the record is what makes the folder count.
The load reads the recorded folder and appends it under the run's name, which a
table takes once. So a run that died half way is started again and goes on where
it stopped: what is recorded is not extracted again, what is loaded not loaded
again, and folders without a record are nobody's.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import in_parallel
from tidemark.sources import store
from tidemark.sources.extract import Extracted, extract_run
from tidemark.sources.files import conform
from tidemark.sources.specs import ExtractSpec, LoadSpec
from tidemark.sources.tables import TableSpec, append_rows, expire_partitions


def in_waves(names: Iterable[str], needs: dict[str, set[str]]) -> list[list[str]]:
    """Names in waves, each after all it needs among them; a cycle is an error."""
    left, waves = set(names), []
    while left:
        ready = sorted(n for n in left if not (needs.get(n, set()) & left) - {n})
        if not ready:
            raise ValueError(f"tables need each other: {sorted(left)}")
        waves.append(ready)
        left -= set(ready)
    return waves


def recorded(spark: SparkSession, manifest: str, run_key: str) -> dict[str, Extracted]:
    """What a run has recorded so far, by table."""
    found = [json.loads(store.read_text(spark, e.path)) for e in store.entries(spark, _run_folder(manifest, run_key)) if e.name.endswith(".json")]
    return {r["table"]: Extracted(**r) for r in found}


def _run_folder(manifest: str, run_key: str) -> str:
    return f"{manifest.rstrip('/')}/run={run_key.replace(':', '')}"


def record(spark: SparkSession, manifest: str, extracted: Extracted) -> None:
    """Make an extract count: a file that is there as a whole, once for each table and run."""
    store.create_once(spark, f"{_run_folder(manifest, extracted.run_key)}/{extracted.table}.json", json.dumps(asdict(extracted)))


def ingest_run(
    spark: SparkSession,
    source: Callable[[str], DataFrame],
    extracts: Iterable[ExtractSpec],
    loads: dict[str, tuple[LoadSpec, TableSpec]],
    run_key: str,
    base: str,
    manifest: str,
    database: str,
    needs: dict[str, set[str]] | None = None,
    threads: int = 4,
) -> dict[str, int]:
    """Rows per table of the run `run_key`; the tables of a wave run side by side.

    `source` gives a table's source rows, `loads` its load and table specs. A
    table without rows in the run is recorded and not loaded. Fields of a load
    spec are conformed to; partitions past its expiration are dropped.
    """
    specs = {e.table: e for e in extracts}
    done = recorded(spark, manifest, run_key)

    def one(name: str) -> None:
        if name not in done:
            attempt = f"{base.rstrip('/')}/{run_key}-{uuid.uuid4().hex[:12]}"
            record(spark, manifest, extract_run(source(name), specs[name], run_key, attempt))
            # Of two attempts side by side the first one recorded counts.
            done[name] = recorded(spark, manifest, run_key)[name]
        if not done[name].row_count:
            return
        load, table = loads[name]
        rows = spark.read.parquet(done[name].folder)
        append_rows(conform(rows, load.fields) if load.fields else rows, f"{database}.{name}", table, f"run-{run_key.replace(':', '')}")

    for wave in in_waves(specs, needs or {}):
        in_parallel([partial(one, name) for name in wave], threads)
    return {name: found.row_count for name, found in done.items() if name in specs}


def expire(spark: SparkSession, loads: dict[str, tuple[LoadSpec, TableSpec]], database: str, today: date) -> dict[str, list[str]]:
    """Drop the partitions of each table that its load spec keeps no longer."""
    return {
        name: expire_partitions(spark, f"{database}.{name}", table, load.expiration_days, today)
        for name, (load, table) in loads.items() if load.expiration_days and table.partition_field
    }
