"""Checks on a table; each one yields a row with the number of violations."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import UNKNOWN

REPORT_SCHEMA = "check_name string, column_name string, violations bigint"


class AuditFailed(Exception):
    """Raised with the failed checks."""

    def __init__(self, failures: list[str]):
        super().__init__("audit failed: " + "; ".join(failures))
        self.failures = failures


@dataclass(frozen=True)
class Relationship:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableAudit:
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    relationships: tuple[Relationship, ...] = ()
    checks: dict[str, Column] = field(default_factory=dict)


def count_failures(df: DataFrame, conditions: dict[tuple[str, str], Column]) -> DataFrame:
    """All row conditions in one pass over the table. A null condition passes."""
    names = list(conditions)
    counted = df.agg(
        *[
            F.coalesce(F.sum((~F.coalesce(conditions[n], F.lit(True))).cast("long")), F.lit(0)).alias(f"_c{i}")
            for i, n in enumerate(names)
        ]
    )
    report = F.array(
        *[
            F.struct(
                F.lit(check).alias("check_name"),
                F.lit(column).alias("column_name"),
                F.col(f"_c{i}").alias("violations"),
            )
            for i, (check, column) in enumerate(names)
        ]
    )
    return counted.select(F.inline(report))


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return count_failures(df, {("not_null", c): F.col(c).isNotNull() for c in columns})


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of key values that occur more than once; nulls are ignored."""
    known = df.select(*columns).na.drop("any")
    repeated = known.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("unique").alias("check_name"), F.lit(",".join(columns)).alias("column_name"), "violations"
    )


def relationship(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, allow_unknown: bool = False
) -> DataFrame:
    """Number of child rows whose key has no parent; null keys pass.

    Child rows are counted per key before they meet the parent, so a popular
    key travels as one row.
    """
    keys = child.filter(F.col(column).isNotNull())
    if allow_unknown:
        keys = keys.filter(F.col(column) != UNKNOWN)
    counted = keys.groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(parent_column).alias("_key")).distinct()
    orphans = counted.join(known, "_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
        F.lit("relationships").alias("check_name"), F.lit(column).alias("column_name"), "violations"
    )


def audit_table(
    df: DataFrame,
    audit: TableAudit,
    parents: dict[str, DataFrame] | None = None,
    allow_unknown: bool = False,
) -> DataFrame:
    """The report of one table."""
    conditions = {("not_null", c): F.col(c).isNotNull() for c in audit.not_null}
    conditions |= {("check", name): condition for name, condition in audit.checks.items()}
    parts = [count_failures(df, conditions)] if conditions else []
    parts += [unique(df, [c]) for c in audit.unique]
    parts += [
        relationship(df, r.column, parents[r.parent], r.parent_column, allow_unknown)
        for r in audit.relationships
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def require_clean(report: DataFrame, table: str = "") -> None:
    """Raise if a check of the report found anything."""
    failed = report.filter("violations > 0").collect()
    if failed:
        raise AuditFailed(
            [f"{table}.{r.column_name} {r.check_name}: {r.violations}".lstrip(".") for r in failed]
        )


def reject_negative(df: DataFrame, column: str) -> DataFrame:
    """Fail the job on the first negative amount."""
    message = F.concat(F.lit(f"negative {column}: "), F.col(column).cast("string"))
    checked = F.when(F.col(column) < 0, F.raise_error(message)).otherwise(F.col(column))
    return df.withColumn(column, checked)
