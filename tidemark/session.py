"""Session settings and the shared working folder."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot keys even where a later step then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The default is a task for each folder listed, and a table by day has thousands.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # What a step has shuffled goes when the step ends: else all steps of a query are on disk at once.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results or plans depend on."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if not current:
            context.setCheckpointDir(named)
        return named
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing folder below the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, so later reads agree with each other."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back."""
    folder = fresh_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small_table(spark: SparkSession, values: dict[str, object], key: str, value: str, kind: str) -> DataFrame:
    """A few known rows as one literal: rows sent from Python would start a Python worker on every core."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(values)), f"map<string,{kind}>")).alias(key, value))


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def in_parallel(tasks: list[Callable[[], object]], threads: int = 4) -> list:
    """Run independent Spark actions side by side; the first error is raised.

    A cluster has room for the small tables while a large one is built.
    """
    with ThreadPoolExecutor(threads) as pool:
        return [future.result() for future in [pool.submit(task) for task in tasks]]
