"""Keyed Parquet tables: upsert, clone, revert, retention and clean-up by partition location.

A table is an external Parquet table with one derived text partition column.
A write puts the partitions it changes into a new folder, commits them to the
table's log (`commits`), and points the catalog at them; folders in use are
never written to. So another table may share them (clone), and earlier versions
can be put back (revert). A writer that another one overtook fails before the
catalog moves; one that died between commit and catalog is caught up by the next.

The log keeps two indexes of each partition, made with it from its written
files: bounds of the time columns, which runs over a window prune by, and
filters of its keys, which an upsert finds the partitions of its keys by.

Raw tables are appended to: each load is a partition of its own below the
derived one, so a load shows as a whole or not at all.

What reaches the driver is the list of partitions, never rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import partial, reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.incremental import RunWindow
from tidemark.operators.keyindex import FILTER_COLUMNS, key_filters, parts_that_may_hold, size_class
from tidemark.operators.latest import latest_per_key
from tidemark.session import empty_table, in_parallel, materialise, shared_folder, small_table
from tidemark.sources import store
from tidemark.sources.commits import ConcurrentWrite, Log, Part, State, micros, now_micros

__all__ = ["ConcurrentWrite"]
NO_VALUE = "none"
LOAD = "part_of_load"
_LOG, _APPLIED, _KEPT_FROM, _APPENDED = "log_folder", "applied_version", "kept_from_version", "appended"
_KEYS, _FROM, _HELD, _FITS = "_keys", "_from_part", "_held_at", "_fits"
# A batch of at least this share of a table's rows is not probed for: it meets the keys of all partitions.
_PROBED_BELOW = 0.25
# One ALTER TABLE names at most this many partitions; more take several statements.
_PER_STATEMENT = 500
_FORMATS = {"HOUR": "%Y-%m-%d-%H", "DAY": "%Y-%m-%d", "MONTH": "%Y-%m", "YEAR": "%Y"}


@dataclass(frozen=True)
class TableSpec:
    """Layout of a table. Without a partition field it is rewritten as a whole."""

    name: str
    keys: tuple[str, ...]
    partition_field: str | None = None
    grain: str = "DAY"
    cluster_by: tuple[str, ...] = ()
    updated_at: str | None = None
    # The partition field of a key never changes: its own partitions are enough to look at.
    fixed_partition: bool = False
    incremental: bool = True
    # Time columns, besides `updated_at`, whose bounds are kept for each partition.
    bounds: tuple[str, ...] = ()
    # Columns, besides the keys, that rows are looked up by.
    lookups: tuple[str, ...] = ()
    # What settles equal times of a key; by default all other columns.
    ties: tuple[str, ...] | None = None

    @property
    def part(self) -> str:
        return "part_of_" + self.partition_field if self.partition_field else ""

    @property
    def tracked(self) -> list[str]:
        return list(dict.fromkeys([*([self.updated_at] if self.updated_at else []), *self.bounds]))


def part_value(field: str, grain: str) -> Column:
    """Partition of a row, as text that sorts like time."""
    formats = {"HOUR": "yyyy-MM-dd-HH", "DAY": "yyyy-MM-dd", "MONTH": "yyyy-MM", "YEAR": "yyyy"}
    return F.coalesce(F.date_format(field, formats[grain]), F.lit(NO_VALUE))


def table_root(spark: SparkSession) -> str:
    """Where tables and databases live: `spark.tidemark.tables`, or a folder below the shared one."""
    return spark.conf.get("spark.tidemark.tables", None) or f"{shared_folder(spark).rstrip('/')}/tables"


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{table_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def read_table(spark: SparkSession, table: str, spec: TableSpec | None = None) -> DataFrame:
    """The table without its partition columns."""
    return _plain(spark.table(table))


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("part_of_")])


def read_days(spark: SparkSession, table: str, spec: TableSpec, first: date, end: date) -> DataFrame:
    """Rows whose partition may hold days [first, end); decided on partition values alone."""
    low = first.strftime(_FORMATS[spec.grain])
    high = (datetime.combine(end, datetime.min.time()) - timedelta(seconds=1)).strftime(_FORMATS[spec.grain])
    return _plain(spark.table(table).filter(F.col(spec.part).between(low, high)))


def _utc(moment: datetime) -> datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def read_changed(spark: SparkSession, table: str, column: str, low: datetime | None, high: datetime | None = None) -> DataFrame:
    """Rows with low <= column < high, from the partitions whose bounds allow one.

    The partitions are named in the plan, so no other is listed or opened. A
    null time is in no window. A column whose bounds the table doesn't keep is
    only filtered. Times without a zone are UTC.
    """
    rows, at = spark.table(table), F.col(column)
    low, high = (m and _utc(m) for m in (low, high))
    if low is None and high is None:
        return _plain(rows)
    state = _log(spark, table).state()
    if any(column in p.bounds for p in state.values()):
        wanted = [k for k, p in state.items() if p.may_hold(column, low and micros(low), high and micros(high))]
        rows = rows.filter(_in_parts(rows.columns, wanted))
    bounds = [at >= F.lit(low)] if low else []
    bounds += [at < F.lit(high)] if high else []
    return _plain(rows.filter(reduce(Column.__and__, bounds)))


def last_change(spark: SparkSession, table: str, column: str) -> datetime | None:
    """Greatest value of a time column; from the log, without a scan, if the table tracks it."""
    state = _log(spark, table).state()
    if state and all(column in p.bounds or not p.rows for p in state.values()):
        tops = [p.bounds[column][1] for p in state.values() if column in p.bounds]
        return datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=max(tops)) if tops else None
    found = spark.table(table).agg(F.unix_micros(F.max(column).cast("timestamp"))).first()[0]
    return None if found is None else datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=found)


def rows_with_keys(spark: SparkSession, table: str, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose `on` columns are in `keys`; only partitions whose filters let one pass are opened."""
    rows, wanted = spark.table(table), keys.select(*on).distinct()
    state = _log(spark, table).state()
    if any(",".join(on) in p.filtered for p in state.values()):
        rows = rows.filter(_in_parts(rows.columns, parts_of_keys(spark, state, keys.select(*on), on)))
    return _plain(rows.join(wanted, on, "left_semi"))


def changed_in_run(
    spark: SparkSession, table: str, at: str, window: RunWindow, target: str | None = None, target_at: str | None = None,
    lookback_days: int = 3, whole_days: bool = True,
) -> DataFrame:
    """Rows of a table changed on the days of the window, or since the target's last change.

    As `changed_rows` (or, with `whole_days=False`, `changed_since`), but the
    bounds are known first, so that partitions without such rows are not opened.
    Everything, if the target isn't there or has no rows.
    """
    if target is None or not table_exists(spark, target):
        return read_table(spark, table)
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    back = timedelta(days=lookback_days)
    if window.given:
        first, end = (datetime.combine(date.fromisoformat(d[:10]), datetime.min.time(), zone) for d in (window.start, window.end))
        return read_changed(spark, table, at, first - back, end)
    last = last_change(spark, target, target_at or at)
    if last is None:
        return read_table(spark, table)
    if whole_days:
        last = datetime.combine(last.astimezone(zone).date(), datetime.min.time(), zone)
    return read_changed(spark, table, at, last - back)


def table_version(spark: SparkSession, table: str) -> int:
    return _log(spark, table).last()


def noted(spark: SparkSession, table: str, prefix: str) -> str | None:
    """The rest of the newest commit's note that starts with `prefix`."""
    log = _log(spark, table)
    for version in reversed(log.versions()):
        operation = log.read(version).operation
        if operation.startswith(prefix):
            return operation.removeprefix(prefix)
    return None


def versions_apart(spark: SparkSession, table: str, version: int) -> tuple[DataFrame, DataFrame]:
    """Rows then and now of the partitions that changed since `version` (0: from nothing), by their files alone.

    LookupError if that version is no longer kept.
    """
    properties, schema = table_properties(spark, table), read_table(spark, table).schema
    if 0 < version < int(properties[_KEPT_FROM]):
        raise LookupError(f"version {version} of {table} is no longer kept")
    log = Log(spark, properties[_LOG])
    now = log.state()
    then = log.state(version) if version else {}

    def read(state: State, other: State) -> DataFrame:
        folders = sorted({p.folder for k, p in state.items() if k not in other or other[k].folder != p.folder})
        return spark.read.schema(schema).parquet(*folders) if folders else empty_table(spark, schema)

    return read(then, now), read(now, then)


def _in_parts(columns: list[str], keys: list[str]) -> Column:
    """Partition predicate for these partitions; for appended tables it may let others of the same loads in."""
    names = [c for c in columns if c.startswith("part_of_")]
    if not names:
        return F.lit(True)
    values = list(zip(*[k.split("/") for k in keys])) or [()] * len(names)
    return reduce(Column.__and__, [F.col(n).isin(sorted(set(v))) for n, v in zip(names, values)])


def guard_schema(df: DataFrame, existing: DataFrame, table: str) -> None:
    """A model may not change its columns once its table exists."""
    def shape(schema: T.StructType) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in schema]

    if sorted(shape(df.schema)) != sorted(shape(existing.schema)):
        raise ValueError(f"schema of {table} changed: {shape(existing.schema)} -> {shape(df.schema)}")


# Writing ----------------------------------------------------------------------


def _write(df: DataFrame, spec: TableSpec, folder: str) -> State:
    """Partitions as folders, rows ranged by partition, clustering and key; what was written.

    The key at the end lets a heavy partition, or a heavy clustering value, be
    written by several tasks.
    """
    by = list(dict.fromkeys([*spec.cluster_by, *spec.keys]))
    if spec.partition_field:
        df = df.withColumn(spec.part, part_value(spec.partition_field, spec.grain))
        by = [spec.part, *by]
    # Ranges are found by a sample, so that all below them runs twice.
    df = materialise(df, "to-range").repartitionByRange(*by).sortWithinPartitions(*by)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(spec.part) if spec.partition_field else writer).parquet(folder)
    return _written(df, spec, folder)


def _written(df: DataFrame, spec: TableSpec, folder: str) -> State:
    """Partitions of a folder with their indexes, read back from its files."""
    spark = df.sparkSession
    if not spec.partition_field:
        return {NO_VALUE: Part(folder)}
    rows = spark.read.schema(df.schema).parquet(folder)
    times = [c for c in spec.tracked if df.schema[c].dataType.typeName() in ("timestamp", "timestamp_ntz", "date")]
    micros_of = {c: F.unix_micros(F.col(c).cast("timestamp")) for c in times}
    totals = rows.groupBy(spec.part).agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(m).alias(f"{n}_{c}") for c, m in micros_of.items() for n, f in (("least", F.min), ("most", F.max))],
    ).collect()
    by_keys = spec.keys and not spec.fixed_partition and spec.incremental
    indexed = [list(spec.keys)] * bool(by_keys) + [[c] for c in spec.lookups]
    if totals and indexed:
        classes = {r[spec.part]: size_class(r.rows) for r in totals}
        filters = [key_filters(rows, names, F.col(spec.part), classes) for names in indexed]
        reduce(DataFrame.unionByName, filters).write.parquet(f"{folder}/{_KEYS}")
    return {
        r[spec.part]: Part(
            f"{folder}/{spec.part}={r[spec.part]}", r.rows,
            {c: [r[f"least_{c}"], r[f"most_{c}"]] for c in times if r[f"least_{c}"] is not None},
            f"{folder}/{_KEYS}" if indexed else None, [",".join(names) for names in indexed],
        )
        for r in totals
    }


def _chunks(items: list, size: int = _PER_STATEMENT) -> Iterable[list]:
    return (items[i : i + size] for i in range(0, len(items), size))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _set(spark: SparkSession, table: str, **properties: object) -> None:
    named = ", ".join(f"{_quoted(k)}={_quoted(str(v))}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({named})")


def _log(spark: SparkSession, table: str) -> Log:
    folder = table_properties(spark, table).get(_LOG)
    if not folder:
        raise LookupError(f"{table} has no commit log")
    return Log(spark, folder)


def table_log(spark: SparkSession, table: str) -> list[tuple[int, datetime, str]]:
    """Version, time and operation of each commit."""
    log = _log(spark, table)
    commits = [log.read(v) for v in log.versions()]
    return [(c.version, datetime.fromtimestamp(c.at / 1e6, timezone.utc), c.operation) for c in commits]


def part_locations(spark: SparkSession, table: str) -> dict[str, str]:
    """Partition -> folder in the last version."""
    return {k: p.folder for k, p in _log(spark, table).state().items()}


def _clause(columns: list[str], key: str) -> str:
    return "PARTITION (" + ", ".join(f"{c}={_quoted(v)}" for c, v in zip(columns, key.split("/"))) + ")"


def _point(spark: SparkSession, table: str, before: State, after: State) -> None:
    """Move, add and drop what differs between two versions in the catalog."""
    columns = [c for c in spark.table(table).columns if c.startswith("part_of_")]
    if not columns:
        if after and after != before:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(after[NO_VALUE].folder)}")
        return
    moved = [k for k in after if k in before and before[k].folder != after[k].folder]
    in_parallel([
        partial(spark.sql, f"ALTER TABLE {table} {_clause(columns, k)} SET LOCATION {_quoted(after[k].folder)}") for k in moved], 8)
    for chunk in _chunks([k for k in after if k not in before]):
        adds = " ".join(f"{_clause(columns, k)} LOCATION {_quoted(after[k].folder)}" for k in chunk)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {adds}")
    for chunk in _chunks([k for k in before if k not in after]):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(_clause(columns, k) for k in chunk)}")


def _measure(spark: SparkSession, table: str) -> None:
    """Let the catalog know the size of the files. Without it Spark takes a
    partitioned table for endless and broadcasts none, however small."""
    spark.catalog.refreshTable(table)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")


def catch_up(spark: SparkSession, table: str) -> tuple[Log, int, State]:
    """Point the catalog at the last version, if a writer died before it did; the log, that version and its partitions."""
    properties = table_properties(spark, table)
    log, applied = Log(spark, properties[_LOG]), int(properties[_APPLIED])
    last = log.last()
    state = log.state(last)
    if applied < last:
        _point(spark, table, log.state(applied), state)
        _set(spark, table, **{_APPLIED: last})
        _measure(spark, table)
    return log, last, state


def _commit(spark: SparkSession, table: str, seen: tuple[Log, int, State], operation: str, parts: State, gone: Iterable[str] = ()) -> None:
    """Commit on top of the version that the writer saw, then move the catalog."""
    log, base, before = seen
    gone = [k for k in gone if k in before]
    version = log.append(base, operation, parts, gone)
    _point(spark, table, before, {k: p for k, p in before.items() if k not in gone} | parts)
    _set(spark, table, **{_APPLIED: version})
    _measure(spark, table)


def _create(spark: SparkSession, table: str, schema: T.StructType, spec: TableSpec, operation: str, parts: State, appended: bool = False) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    names = [*([spec.part] if spec.partition_field else []), *([LOAD] if appended else [])]
    columns += "".join(f", `{n}` string" for n in names)
    partitioned = f"PARTITIONED BY ({', '.join(names)})" if names else ""
    kind = "incremental" if spec.incremental else "table"
    home = _new_folder(spark, table)
    location = f"{home}/data" if names else parts[NO_VALUE].folder
    log = Log(spark, f"{home}/_log")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet {partitioned} LOCATION {_quoted(location)} TBLPROPERTIES "
        f"('materialization'='{kind}', '{_APPENDED}'='{str(appended).lower()}', '{_LOG}'={_quoted(log.folder)}, '{_APPLIED}'='0', '{_KEPT_FROM}'='1')"
    )
    _commit(spark, table, (log, 0, {}), operation, parts)


def replace_table(df: DataFrame, table: str, spec: TableSpec) -> None:
    """Full refresh into new folders; readers move over when they are complete."""
    spark = df.sparkSession
    folder = _new_folder(spark, table)
    if not table_exists(spark, table):
        _create(spark, table, df.schema, spec, "create", _write(df, spec, folder))
        return
    guard_schema(df, read_table(spark, table), table)
    seen = catch_up(spark, table)
    parts = _write(df, spec, folder)
    _commit(spark, table, seen, "replace", parts, set(seen[2]) - set(parts))


def upsert(
    df: DataFrame, table: str, spec: TableSpec, newer_wins: bool = True, note: str | None = None, one_per_key: bool = False
) -> None:
    """Replace the rows of `table` that share a key with `df`, and add the others.

    Rewritten are the partitions the new rows go to and those that hold the
    keys now: a key may have moved. The key filters tell which those can be; no
    other partition is opened. With `newer_wins`, rows older than what the table
    has are ignored, so that an old window can be run again. `note` goes to the
    log, in the same commit. `one_per_key` says that no two rows of `df` share a
    key, so that the latest of each need not be found first.
    """
    spark = df.sparkSession
    keys = list(spec.keys)
    if spec.updated_at and not one_per_key:
        df = latest_per_key(df, keys, spec.updated_at, None if spec.ties is None else list(spec.ties))
    if not table_exists(spark, table):
        _create(spark, table, df.schema, spec, note or "create", _write(df, spec, _new_folder(spark, table)))
        return
    seen = catch_up(spark, table)
    existing = spark.table(table)
    guard_schema(df, read_table(spark, table), table)
    columns = [c for c in existing.columns if c != spec.part]
    # The batch is read several times below and may be an expensive plan.
    batch = materialise(df.select(*columns), table + "-batch")
    if not spec.partition_field:
        fresh = _accepted(batch, _held(batch, existing, spec), spec) if newer_wins and spec.updated_at else batch
        rest = existing.select(*columns).join(fresh.select(*keys), keys, "left_anti")
        parts = _write(rest.select(*columns).unionByName(fresh), spec, _new_folder(spark, table))
        _commit(spark, table, seen, note or "upsert", parts)
        return
    placed = batch.withColumn(spec.part, part_value(spec.partition_field, spec.grain))
    scope = existing.filter(F.col(spec.part).isin(
        _values(placed, spec.part) if spec.fixed_partition else parts_of_keys(spark, seen[2], batch, keys)))
    if newer_wins and spec.updated_at:
        # One narrow join tells which rows are too old and where the others' keys are now. Mostly none is, and the rows stay as they are.
        held = materialise(_held(batch, scope, spec), table + "-held")
        fresh = placed if held.filter(~F.col(_FITS)).isEmpty() else materialise(_accepted(placed, held, spec), table + "-fresh")
        left = held.filter(_FITS).select(F.col(_FROM).alias(spec.part))
    else:
        fresh, left = placed, scope.join(batch.select(*keys), keys, "left_semi").select(spec.part)
    affected = _values(fresh.select(spec.part).unionByName(left), spec.part)
    if not affected:
        if note:
            _commit(spark, table, seen, note, {})
        return
    old = existing.filter(F.col(spec.part).isin(affected))
    rest = old.join(fresh.select(*keys), keys, "left_anti")
    parts = _write(rest.select(*columns).unionByName(fresh.select(*columns)), spec, _new_folder(spark, table))
    _commit(spark, table, seen, note or "upsert", parts, set(affected) - set(parts))


def _is_large(state: State, batch: DataFrame) -> bool:
    return batch.count() >= _PROBED_BELOW * sum(p.rows for p in state.values()) > 0


def large_part(spark: SparkSession, table: str, batch: DataFrame) -> bool:
    """Whether a batch is a large part of the table, so that looking its keys up costs more than reading all."""
    return _is_large(_log(spark, table).state(), batch)


def parts_of_keys(spark: SparkSession, state: State, batch: DataFrame, keys: list[str]) -> list[str]:
    """Partitions that may hold a key of `batch`, by their key filters; those without filters always.

    All of them for a batch that is a large part of the table: probing moves
    every key for each size of filter, more than the keys of the table are.
    """
    if _is_large(state, batch):
        return list(state)
    named = ",".join(keys)
    without = [k for k, p in state.items() if named not in p.filtered]
    filtered = {k: p for k, p in state.items() if named in p.filtered}
    if not filtered:
        return without
    live = small_table(spark, {k: p.keys for k, p in filtered.items()}, "part", "_home", "string")
    # A row's home is the folder it stands in, with the scheme that the store gives it.
    home = F.regexp_replace(F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1), r"^\w+:/*", "/")
    filters = spark.read.schema(FILTER_COLUMNS).parquet(*sorted({p.keys for p in filtered.values()})).withColumn("_home", home)
    # As many rows as partitions.
    current = F.broadcast(live.withColumn("_home", F.regexp_replace("_home", r"^\w+:/*", "/")))
    found = parts_that_may_hold(
        filters.filter(F.col("columns") == named).join(current, ["part", "_home"], "left_semi"), batch, keys, {size_class(p.rows) for p in filtered.values()})
    return without + [r.part for r in found.collect()]


def remove_keys(gone: DataFrame, table: str, spec: TableSpec) -> None:
    """Remove the rows of `table` with a key of `gone`; only partitions that hold one are rewritten."""
    spark, keys = gone.sparkSession, list(spec.keys)
    seen = catch_up(spark, table)
    existing = spark.table(table)
    columns = [c for c in existing.columns if c != spec.part]
    gone = materialise(gone.select(*keys).distinct(), table + "-gone")
    if gone.isEmpty():
        return
    if not spec.partition_field:
        rest = existing.select(*columns).join(gone, keys, "left_anti").select(*columns)
        _commit(spark, table, seen, "remove", _write(rest, spec, _new_folder(spark, table)))
        return
    scope = existing.filter(F.col(spec.part).isin(parts_of_keys(spark, seen[2], gone, keys)))
    affected = _values(scope.join(gone, keys, "left_semi"), spec.part)
    if not affected:
        return
    rest = existing.filter(F.col(spec.part).isin(affected)).join(gone, keys, "left_anti")
    parts = _write(rest.select(*columns), spec, _new_folder(spark, table))
    _commit(spark, table, seen, "remove", parts, set(affected) - set(parts))


def _held(batch: DataFrame, existing: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys of the batch that the table has: since when, in which partition, and whether the batch's row is not older."""
    keys = list(spec.keys)
    place = F.col(spec.part) if spec.partition_field else F.lit(NO_VALUE)
    now = existing.select(*keys, F.col(spec.updated_at).alias(_HELD), place.alias(_FROM))
    fits = F.col(_HELD).isNull() | F.coalesce(F.col(spec.updated_at) >= F.col(_HELD), F.lit(False))
    return batch.select(*keys, spec.updated_at).join(now, keys).select(*keys, _HELD, _FROM, fits.alias(_FITS))


def _accepted(batch: DataFrame, held: DataFrame, spec: TableSpec) -> DataFrame:
    """Batch rows that are not older than the row they would replace."""
    keys = list(spec.keys)
    newer = held.filter(~F.col(_FITS)).select(*keys, _HELD).distinct()
    fits = F.col(_HELD).isNull() | (F.col(spec.updated_at) >= F.col(_HELD))
    return batch.join(newer, keys, "left").filter(fits).select(*batch.columns)


def _values(df: DataFrame, column: str) -> list[str]:
    """Distinct partition values: metadata, bounded by the number of partitions."""
    return [row[0] for row in df.select(column).distinct().collect()]


def upserted(existing: DataFrame, batch: DataFrame, keys: list[str], updated_at: str | None = None) -> DataFrame:
    """What a keyed table holds after an upsert, as a frame."""
    if updated_at:
        batch = latest_per_key(batch, keys, updated_at)
    return existing.join(batch.select(*keys), keys, "left_anti").select(*existing.columns).unionByName(
        batch.select(*existing.columns)
    )


# Versions -----------------------------------------------------------------------


def clone_table(spark: SparkSession, source: str, target: str, spec: TableSpec) -> None:
    """A second table over the same folders, with their indexes. Writes to either leave the other alone."""
    _, _, state = catch_up(spark, source)
    schema = read_table(spark, source).schema
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    _create(spark, target, schema, spec, "clone", state)


def revert_table(spark: SparkSession, table: str, spec: TableSpec, to: datetime | None = None, minutes: int = 360) -> None:
    """Put the version of `to`, by default `minutes` ago, back as a new one.

    Any version since the table was made can be put back, unless `vacuum` has
    freed it. The revert is a change that can be reverted.
    """
    seen = catch_up(spark, table)
    log, last, state = seen
    version = log.version_at(micros(_utc(to) if to else datetime.now(timezone.utc) - timedelta(minutes=minutes)))
    if version < int(table_properties(spark, table)[_KEPT_FROM]):
        raise LookupError(f"{table} has no version that old")
    if version == last:
        return
    then = log.state(version)
    changed = {k: p for k, p in then.items() if state.get(k) != p}
    _commit(spark, table, seen, f"revert to {version}", changed, set(state) - set(then))


def expire_partitions(spark: SparkSession, table: str, spec: TableSpec, days: int, today: date) -> list[str]:
    """Drop partitions that ended more than `days` days ago; `vacuum` frees their files."""
    limit = (today - timedelta(days=days)).strftime(_FORMATS[spec.grain])
    seen = catch_up(spark, table)
    old = sorted(k for k in seen[2] if k.split("/")[0] != NO_VALUE and k.split("/")[0] < limit)
    if old:
        _commit(spark, table, seen, "expire", {}, old)
    return old


def _logged_tables(spark: SparkSession) -> dict[str, dict[str, str]]:
    """Properties of every table of the catalog that has a log."""
    found = {}
    for database in [r.namespace for r in spark.sql("SHOW DATABASES").collect()]:
        for row in spark.sql(f"SHOW TABLES IN {database}").filter("NOT isTemporary").collect():
            name = f"{database}.{row.tableName}"
            if spark.catalog.getTable(name).tableType not in ("VIEW", "TEMPORARY"):
                properties = table_properties(spark, name)
                if _LOG in properties:
                    found[name] = properties
    return found


def vacuum(spark: SparkSession, retention: timedelta, now: datetime | None = None) -> list[str]:
    """Free the folders below the table root that no kept version of any table uses; their paths.

    Kept are, for every table of the catalog, the last version, the one that was
    in force `retention` ago and all since; also what is younger than
    `retention`, as a writer may not have committed it yet. Clones and both mart
    databases are tables as any other, so shared folders stay while one of them
    uses them. The catalog has to name all tables of the root.
    """
    since = micros(now or datetime.now(timezone.utc)) - round(retention.total_seconds() * 1e6)
    used: set[str] = set()
    for name, properties in _logged_tables(spark).items():
        log = Log(spark, properties[_LOG])
        kept_from = max(log.version_at(since), int(properties[_KEPT_FROM]))
        used.add(_child_of_root(spark, log.folder))
        for version in [v for v in log.versions() if v >= kept_from]:
            parts = (log.state(version) if version == kept_from else log.read(version).parts).values()
            used |= {_child_of_root(spark, p.folder) for p in parts}
        if kept_from > int(properties[_KEPT_FROM]):
            _set(spark, name, **{_KEPT_FROM: kept_from})
    for row in spark.sql("SHOW DATABASES").collect():
        used.add(_child_of_root(spark, spark.catalog.getDatabase(row.namespace).locationUri))
    return _sweep(spark, table_root(spark), since, lambda e: e.name in used)


def sweep_scratch(spark: SparkSession, retention: timedelta) -> list[str]:
    """Free what `materialise` wrote to the shared folder more than `retention` ago; their paths. No running job may be that old."""
    since = now_micros() - round(retention.total_seconds() * 1e6)

    def keep(entry: store.Entry) -> bool:
        name = entry.name.rsplit("-", 1)
        return len(name) < 2 or len(name[1]) != 32 or not all(c in "0123456789abcdef" for c in name[1])

    return _sweep(spark, shared_folder(spark), since, keep)


def _child_of_root(spark: SparkSession, path: str) -> str:
    """Name of the folder directly below the table root that holds a path; '' for another root."""
    root = "/" + table_root(spark).split(":", 1)[-1].strip("/") + "/"
    plain = "/" + path.split(":", 1)[-1].strip("/") + "/"
    return plain[len(root):].split("/", 1)[0] if plain.startswith(root) else ""


def _sweep(spark: SparkSession, root: str, since: int, keep: Callable[[store.Entry], bool]) -> list[str]:
    old = [e.path for e in store.entries(spark, root) if e.is_folder and e.modified_micros < since and not keep(e)]
    for path in old:
        store.delete_folder(spark, path)
    return old


# Appending ------------------------------------------------------------------------


def append_files(spark: SparkSession, paths: list[str], table: str, spec: TableSpec, load: str | None = None) -> None:
    """Append Parquet files to a raw table, creating it from the first ones."""
    if not paths:
        raise LookupError(f"no files to load into {table}")
    append_rows(spark.read.parquet(*paths), table, spec, load)


def append_rows(df: DataFrame, table: str, spec: TableSpec, load: str | None = None) -> None:
    """Append by column name; one Spark job whatever the number of files.

    The rows are a load of their own: all of it shows, or nothing. A `load` that
    the table has already is not appended again, so a run can be repeated.
    """
    spark = df.sparkSession
    load = (load or uuid.uuid4().hex[:12]).replace("/", "_")
    new = not table_exists(spark, table)
    seen = None
    if not new:
        existing = spark.table(table)
        if LOAD not in existing.columns:
            raise ValueError(f"{table} is no table to append to")
        guard_schema(df, _plain(existing), table)
        seen = catch_up(spark, table)
        if any(k.split("/")[-1] == load for k in seen[2]):
            return
        df = df.select(*_plain(existing).columns)
    parts = _loaded(df, table, spec, load)
    if new:
        _create(spark, table, df.schema, spec, f"append {load}", parts, appended=True)
    else:
        _commit(spark, table, seen, f"append {load}", parts)


def _loaded(df: DataFrame, table: str, spec: TableSpec, load: str) -> State:
    parts = _write(df, TableSpec(
        spec.name, tuple(spec.cluster_by or spec.keys), spec.partition_field, spec.grain, fixed_partition=True,
        updated_at=spec.updated_at, bounds=spec.bounds), _new_folder(df.sparkSession, table))
    if not spec.partition_field:
        return {load: parts[NO_VALUE]}
    return {f"{k}/{load}": p for k, p in parts.items()}


def compact(spark: SparkSession, table: str, spec: TableSpec, most_loads: int = 8) -> list[str]:
    """Put the loads of each partition that has more than `most_loads` of them into one; the partitions."""
    seen = catch_up(spark, table)
    loads: dict[str, list[str]] = {}
    for key in seen[2]:
        loads.setdefault(key.split("/")[0] if spec.partition_field else "", []).append(key)
    many = {value: keys for value, keys in loads.items() if len(keys) > most_loads}
    if many:
        rows = spark.table(table)
        rows = rows.filter(F.col(spec.part).isin(list(many))) if spec.partition_field else rows
        parts = _loaded(_plain(rows), table, spec, f"compacted-{uuid.uuid4().hex[:12]}")
        _commit(spark, table, seen, "compact", parts, [k for keys in many.values() for k in keys])
    return sorted(many)


def seed_if_empty(df: DataFrame, table: str, spec: TableSpec) -> bool:
    """Insert seed rows by name unless the table already has rows."""
    spark = df.sparkSession
    if table_exists(spark, table) and not spark.table(table).isEmpty():
        return False
    append_rows(df, table, spec)
    return True


def create_database(spark: SparkSession, name: str, comment: str = "", labels: dict[str, str] | None = None) -> None:
    properties = ", ".join(f"{_quoted(k)}={_quoted(v)}" for k, v in (labels or {}).items())
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {_quoted(comment)} LOCATION {_quoted(_new_folder(spark, name))}"
        + (f" WITH DBPROPERTIES ({properties})" if properties else "")
    )
