"""Write, audit, publish: two mart databases and the views in front of them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.audit import AuditFailed, TableAudit, audit_table
from tidemark.session import in_parallel
from tidemark.sources.tables import TableSpec, clone_table, read_table, table_properties

STATUS = "deployment_status"


class RoleError(Exception):
    """The databases do not say clearly which of them is live."""


@dataclass(frozen=True)
class Roles:
    live: str
    audit: str


def database_properties(spark: SparkSession, database: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").filter("info_name = 'Properties'").collect()
    text = rows[0].info_value if rows else ""
    return dict(re.findall(r"\(([^(),]+),([^()]*)\)", text))


def set_status(spark: SparkSession, database: str, status: str) -> None:
    spark.sql(f"ALTER DATABASE {database} SET DBPROPERTIES ('{STATUS}'='{status}')")


def read_roles(spark: SparkSession, default_live: str, default_audit: str) -> Roles:
    """Roles from the database properties; the defaults are set where one is missing."""
    found: dict[str, list[str]] = {"live": [], "audit": []}
    for database in (default_live, default_audit):
        status = database_properties(spark, database).get(STATUS, "")
        if status in found:
            found[status].append(database)
    for status, databases in found.items():
        if len(databases) > 1:
            raise RoleError(f"more than one {status} database: {databases}")
    if found["live"] and found["audit"]:
        return Roles(found["live"][0], found["audit"][0])
    set_status(spark, default_live, "live")
    set_status(spark, default_audit, "audit")
    return Roles(default_live, default_audit)


def table_names(spark: SparkSession, database: str) -> list[str]:
    return [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").filter("NOT isTemporary").collect()]


def clear_database(spark: SparkSession, database: str) -> list[str]:
    """Drop the tables of a database. Its properties stay, and so do the files:
    the other side may still use them."""
    names = table_names(spark, database)
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    return names


def is_incremental(spark: SparkSession, table: str) -> bool:
    return table_properties(spark, table).get("materialization") == "incremental"


def clone_incremental(spark: SparkSession, roles: Roles, specs: dict[str, TableSpec]) -> list[str]:
    """Give the audit side the incremental tables of the live side, without copying data."""
    cloned = []
    for name in table_names(spark, roles.live):
        if name in specs and is_incremental(spark, f"{roles.live}.{name}"):
            clone_table(spark, f"{roles.live}.{name}", f"{roles.audit}.{name}", specs[name])
            cloned.append(name)
    return cloned


def prepare_audit(spark: SparkSession, roles: Roles, specs: dict[str, TableSpec]) -> list[str]:
    clear_database(spark, roles.audit)
    return clone_incremental(spark, roles, specs)


def audit_report(
    spark: SparkSession, database: str, audits: dict[str, TableAudit], allow_unknown: bool = False
) -> dict[str, DataFrame]:
    """A report per table of the database that has an audit."""
    names = set(table_names(spark, database))
    frames = {name: read_table(spark, f"{database}.{name}") for name in names}
    return {
        name: audit_table(frames[name], audit, frames, allow_unknown)
        for name, audit in audits.items() if name in frames
    }


def require_audit(
    spark: SparkSession, database: str, audits: dict[str, TableAudit], allow_unknown: bool = False
) -> None:
    """Run all audits, then raise if any failed."""
    reports = audit_report(spark, database, audits, allow_unknown)
    if not reports:
        return
    named = [report.withColumn("table_name", F.lit(name)) for name, report in reports.items()]
    found = in_parallel([lambda r=report: r.filter("violations > 0").collect() for report in named])
    failures = [
        f"{row.table_name}.{row.column_name} {row.check_name}: {row.violations}" for rows in found for row in rows
    ]
    if failures:
        raise AuditFailed(failures)


def publish_views(spark: SparkSession, database: str, live_views: str) -> list[str]:
    """Point a view per table at `database`. Each view moves at once; the set does not."""
    views = []
    for name in sorted(table_names(spark, database)):
        columns = ", ".join(f"`{c}`" for c in read_table(spark, f"{database}.{name}").columns)
        spark.sql(f"CREATE OR REPLACE VIEW {live_views}.live_{name} AS SELECT {columns} FROM {database}.{name}")
        views.append(f"live_{name}")
    return views


def swap_roles(spark: SparkSession, roles: Roles) -> Roles:
    """The audited side becomes live. What the databases say afterwards must agree."""
    set_status(spark, roles.live, "audit")
    set_status(spark, roles.audit, "live")
    now = read_roles(spark, roles.live, roles.audit)
    if now != Roles(live=roles.audit, audit=roles.live):
        raise RoleError(f"roles after the swap are {now}, before it {roles}")
    return now


def audit_and_publish(
    spark: SparkSession,
    roles: Roles,
    live_views: str,
    audits: dict[str, TableAudit],
    allow_unknown: bool = False,
    drop_stale: bool = False,
) -> Roles:
    """Publish the audit side if all its checks pass; otherwise nothing moves."""
    require_audit(spark, roles.audit, audits, allow_unknown)
    publish_views(spark, roles.audit, live_views)
    swapped = swap_roles(spark, roles)
    if drop_stale:
        clear_database(spark, swapped.audit)
    return swapped
