"""Structured Streaming jobs: the same operators, fed by new files.

All run with `availableNow`: they take what is new since their checkpoint and
stop, so a scheduler can start them like a batch job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.history import build_history, history_changes
from tidemark.operators.pointintime import pit_join
from tidemark.sources.tables import TableSpec, read_table, table_exists, upsert


def new_files(
    spark: SparkSession, folder: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the Parquet files that appear in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_to_end(writer) -> None:
    """Work off what is there, then stop; errors of the stream are raised."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def append_stream(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Append to a Parquet folder, each new file exactly once."""
    run_to_end(
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", folder).option("checkpointLocation", checkpoint)
    )


def for_each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    run_to_end(stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint))


def upsert_stream(stream: DataFrame, table: str, spec: TableSpec, checkpoint: str) -> None:
    """Latest row per key of each micro-batch into a keyed table.

    A batch that is run again after a failure changes nothing: same keys, same
    rows, and older rows never replace newer ones.
    """

    def work(batch: DataFrame, _: int) -> None:
        upsert(batch, table, spec)

    for_each_batch(stream, work, checkpoint)


def history_stream(
    stream: DataFrame,
    table: str,
    spec: TableSpec,
    keys: list[str],
    updated_at: str,
    checkpoint: str,
    ties: list[str] | None = None,
) -> None:
    """Keep a type 2 history up to date with a change feed."""

    def work(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        if table_exists(spark, table):
            rows = history_changes(read_table(spark, table), batch, keys, updated_at, ties)
        else:
            rows = build_history(batch, keys, updated_at, ties)
        upsert(rows, table, spec)

    for_each_batch(stream, work, checkpoint)


def drop_redelivered(stream: DataFrame, keys: list[str], at: str, lateness: str = "3 days") -> DataFrame:
    """Drop repeated deliveries of a row that arrive within the lateness.

    The first delivery is kept; where the newest has to win, use `upsert_stream`.
    State holds the keys of the lateness span only.
    """
    return stream.withWatermark(at, lateness).dropDuplicatesWithinWatermark(keys)


def late_tolerant_counts(stream: DataFrame, at: str, width: str, keys: list[str], lateness: str = "3 days") -> DataFrame:
    """Counts per key and time window, final once the lateness has passed."""
    return (
        stream.withWatermark(at, lateness).groupBy(F.window(at, width), *keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.col("window.start").alias("window_start"), *keys, "rows")
    )


def enrich_stream(
    stream: DataFrame, versions: DataFrame, on: list[tuple[str, str]], at: str, take: dict[str, str]
) -> DataFrame:
    """Point-in-time lookup of streamed facts in a static dimension."""
    return pit_join(stream, versions, on, at, take, merge=False)
