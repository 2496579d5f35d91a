"""Windowed extracts into a Parquet lake, and the hand-off to the load."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import key_bounds, lake_columns, window_bounds
from tidemark.operators.latest import latest_per_key
from tidemark.sources.specs import ExtractSpec

MANIFEST_SCHEMA = "table_name string, run_key string, folder string, row_count bigint, written_at timestamp"


def window_extract(
    df: DataFrame, date_field: str, start: datetime, end: datetime, columns: list[str] | None = None
) -> DataFrame:
    """Rows with start <= date_field < end; both bounds reach the file scan.

    Bounds without a zone are in the session's time zone, wherever the driver runs.
    """
    at = F.col(date_field)
    kind = df.schema[date_field].dataType.simpleString()
    low, high = (F.lit(bound.isoformat(sep=" ")).cast(kind) for bound in (start, end))
    rows = df.filter((at >= low) & (at < high))
    return rows.select(*chosen_columns(df, columns)) if columns else rows


def chosen_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """The requested columns, provided they are identifiers the frame has."""
    for name in columns:
        if not name.isidentifier():
            raise ValueError(f"{name!r} is not a valid identifier")
        if name not in df.columns:
            raise ValueError(f"no column {name!r}")
    return columns


def lake_folder(base: str, spec: ExtractSpec, start: datetime) -> str:
    """Folder of one run: the layout's levels, then the run where several share them."""
    iso_year, iso_week, _ = start.isocalendar()
    levels = {
        "weekly": f"year={iso_year}/week={iso_week:02}",
        "monthly": f"year={start.year}/month={start.month:02}",
    }.get(spec.lake_layout, f"year={start.year}/month={start.month:02}/day={start.day:02}")
    run = ""
    if spec.lake_layout in ("weekly", "monthly"):
        run = f"{start:%m%d}"
    if spec.grain == "hourly":
        run += f"{start:%H}"
    return f"{base.rstrip('/')}/{spec.table}/{levels}" + (f"/run={run}" if run else "")


@dataclass(frozen=True)
class Extracted:
    table: str
    run_key: str
    folder: str
    row_count: int


def extract_run(df: DataFrame, spec: ExtractSpec, run_key: str, base: str) -> Extracted:
    """Write the window of one run key. A repeated run replaces its own files only."""
    start, end = window_bounds(run_key, spec.grain)
    columns = None if spec.load_all_columns else list(spec.columns) or None
    counted = Observation()
    rows = window_extract(df, spec.date_field, start, end, columns)
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    folder = lake_folder(base, spec, start)
    writer = rows.write.mode("overwrite").option("compression", spec.codec)
    if spec.chunk_size:
        writer = writer.option("maxRecordsPerFile", spec.chunk_size)
    writer.parquet(folder)
    return Extracted(spec.table, run_key, folder, counted.get["rows"])


def extract_range(
    df: DataFrame, spec: ExtractSpec, start: datetime, end: datetime, base: str, manifest: str | None = None
) -> str:
    """Backfill [start, end) in one job, each row in the folder of its own run.

    Both bounds have to be starts of runs. The folders of runs with rows are
    replaced, so a range can be extracted again, after or before single runs; a
    run that has no rows any more keeps its folder. With `manifest`, each run is
    recorded there, so that its load can find it. Rows are ranged by folder and
    time: a heavy day is written by several tasks, a light one by one.
    """
    label = "%Y-%m-%d-%H:%M" if spec.grain == "hourly" else "%Y-%m-%d"
    for bound in (start, end):
        if window_bounds(bound.strftime(label), spec.grain)[0] != bound:
            raise ValueError(f"{bound} is not the start of a {spec.grain} run")
    columns = None if spec.load_all_columns else list(spec.columns) or None
    rows = window_extract(df, spec.date_field, start, end)
    begin, _ = key_bounds(spec.date_field, spec.grain)
    levels = {
        name: column.cast("string") if name == "year" else F.lpad(column.cast("string"), 2, "0")
        for name, column in lake_columns(begin, spec.lake_layout).items()
    }
    run = ("MMdd" if spec.lake_layout in ("weekly", "monthly") else "") + ("HH" if spec.grain == "hourly" else "")
    if run:
        levels["run"] = F.date_format(begin, run)
    folder = f"{base.rstrip('/')}/{spec.table}"
    chosen = chosen_columns(df, columns) if columns else df.columns
    placed = rows.withColumns(levels).repartitionByRange(*levels, spec.date_field, F.xxhash64(*chosen))
    writer = (
        placed.select(*chosen, *levels).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*levels).option("compression", spec.codec)
    )
    if spec.chunk_size:
        writer = writer.option("maxRecordsPerFile", spec.chunk_size)
    writer.parquet(folder)
    if manifest:
        parts = F.concat_ws("/", F.lit(folder), *[F.concat(F.lit(f"{name}="), value) for name, value in levels.items()])
        key = F.date_format(begin, "yyyy-MM-dd-HH:mm" if spec.grain == "hourly" else "yyyy-MM-dd")
        runs = rows.groupBy(key.alias("run_key"), parts.alias("folder")).agg(F.count(F.lit(1)).alias("row_count"))
        runs.select(
            F.lit(spec.table).alias("table_name"), "run_key", "folder", "row_count",
            F.current_timestamp().alias("written_at"),
        ).write.mode("append").parquet(manifest)
    return folder


def record_run(spark: SparkSession, manifest: str, extracted: Extracted) -> None:
    """Append what a run wrote to the manifest folder."""
    row = (extracted.table, extracted.run_key, extracted.folder, extracted.row_count, datetime.now(timezone.utc))
    spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(manifest)


def folder_of_run(spark: SparkSession, manifest: str, table: str, run_key: str) -> str:
    """Folder the load has to read; an absent or empty run is an error."""
    runs = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest).filter(
        (F.col("table_name") == table) & (F.col("run_key") == run_key)
    )
    row = latest_per_key(runs, ["table_name", "run_key"], "written_at").first()
    if row is None:
        raise LookupError(f"no extract of {table} for {run_key}")
    if not row.row_count:
        raise LookupError(f"the extract of {table} for {run_key} is empty")
    return row.folder
