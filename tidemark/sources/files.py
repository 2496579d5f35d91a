"""Reading and conforming external files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.specs import FieldSpec


def read_csv(
    spark: SparkSession, path: str, schema: str, columns: list[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header; quoted fields may hold quotes, and span lines with `multi_line`, which reads a file in one task."""
    df = spark.read.csv(path, schema=schema, header=True, multiLine=multi_line, quote='"', escape='"')
    return df.select(*columns) if columns else df


def read_json(
    spark: SparkSession, path: str, schema: str, columns: list[str] | None = None, whole_files: bool = False
) -> DataFrame:
    """JSON lines; with `whole_files`, one array of objects per file."""
    df = spark.read.json(path, schema=schema, multiLine=whole_files)
    return df.select(*columns) if columns else df


def struct_of(fields: tuple[FieldSpec, ...]) -> T.StructType:
    """Schema of a list of fields."""
    ddl = [
        f"`{f.name}` {f'array<{f.type}>' if f.mode == 'REPEATED' else f.type}"
        + (" NOT NULL" if f.mode == "REQUIRED" else "")
        for f in fields
    ]
    return T.StructType.fromDDL(", ".join(ddl))


def conform(df: DataFrame, fields: tuple[FieldSpec, ...]) -> DataFrame:
    """Select, round and cast to an explicit schema; a null in a REQUIRED field fails the job."""
    columns = []
    for field, typed in zip(fields, struct_of(fields), strict=True):
        column: Column = F.col(field.name)
        if field.rounding and isinstance(typed.dataType, T.DecimalType):
            rounded = F.round if field.rounding == "HALF_UP" else F.bround
            column = rounded(column, typed.dataType.scale)
        column = column.cast(typed.dataType)
        if field.mode == "REQUIRED":
            missing = F.raise_error(F.lit(f"null in required field {field.name}"))
            column = F.coalesce(column, missing.cast(typed.dataType))
        columns.append(column.alias(field.name))
    return df.select(*columns)
