"""Run windows, lake layout and date labels as expressions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("hourly", "daily", "weekly", "monthly")


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def window_bounds(key: str, grain: str) -> tuple[datetime, datetime]:
    """Half-open bounds of the run named by a partition key."""
    if grain not in GRAINS:
        raise ValueError(f"unsupported partition grain: {grain!r}")
    if grain == "hourly":
        start = datetime.strptime(key, "%Y-%m-%d-%H:%M")
        return start, start + timedelta(hours=1)
    day = datetime.strptime(key, "%Y-%m-%d")
    if grain == "daily":
        return day, day + timedelta(days=1)
    if grain == "weekly":
        monday = day - timedelta(days=day.weekday())
        return monday, monday + timedelta(days=7)
    first = day.replace(day=1)
    return first, (first + timedelta(days=32)).replace(day=1)


def key_bounds(at: Column | str, grain: str) -> tuple[Column, Column]:
    """`window_bounds` for every row of a timestamp column."""
    units = {"hourly": "HOUR", "daily": "DAY", "weekly": "WEEK", "monthly": "MONTH"}
    if grain not in units:
        raise ValueError(f"unsupported partition grain: {grain!r}")
    start = F.date_trunc(units[grain], _col(at))
    steps = {
        "hourly": F.make_dt_interval(hours=F.lit(1)),
        "daily": F.make_dt_interval(days=F.lit(1)),
        "weekly": F.make_dt_interval(days=F.lit(7)),
        "monthly": F.make_ym_interval(months=F.lit(1)),
    }
    return start, start + steps[grain]


def day_bounds(start: str, end: str, lookback_days: int = 0) -> tuple[Column, Column]:
    """First day (moved back by the lookback) and exclusive last day as date literals."""
    return F.date_sub(F.lit(start).cast("date"), lookback_days), F.lit(end).cast("date")


def lake_columns(at: Column | str, layout: str) -> dict[str, Column]:
    """Partition columns of a lake layout.

    Weeks go below their ISO year: 2024-12-30 belongs to week 1 of 2025.
    """
    at = _col(at)
    if layout == "weekly":
        return {"year": F.extract(F.lit("YEAROFWEEK"), at), "week": F.weekofyear(at)}
    columns = {"year": F.year(at), "month": F.month(at)}
    if layout in ("daily", "hourly"):
        columns["day"] = F.day(at)
    elif layout != "monthly":
        raise ValueError(f"unsupported lake layout: {layout!r}")
    return columns


def day_suffix(day: Column) -> Column:
    """English ordinal suffix of a day of the month."""
    return (
        F.when(day.between(11, 13), F.lit("th"))
        .when(day % 10 == 1, F.lit("st"))
        .when(day % 10 == 2, F.lit("nd"))
        .when(day % 10 == 3, F.lit("rd"))
        .otherwise(F.lit("th"))
    )


def effective_change(modified: str = "date_modified", deleted: str = "date_deleted") -> Column:
    """Change time for sources that do not touch `modified` on a soft delete."""
    return F.greatest(F.col(modified), F.coalesce(F.col(deleted), F.lit("1970-01-01").cast("timestamp")))
