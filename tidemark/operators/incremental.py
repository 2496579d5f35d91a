"""Which rows an incremental run has to read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day_bounds
from tidemark.operators.sets import rows_of


@dataclass(frozen=True)
class RunWindow:
    """Days [start, end) of a run; without them a run follows its target."""

    start: str | None = None
    end: str | None = None

    def __post_init__(self) -> None:
        if (self.start is None) != (self.end is None):
            raise ValueError("a run window needs both its start and its end")

    @property
    def given(self) -> bool:
        return self.start is not None


def changed_rows(
    source: DataFrame,
    modified: str,
    window: RunWindow,
    target: DataFrame | None = None,
    target_modified: str | None = None,
    lookback_days: int = 3,
) -> DataFrame:
    """Rows changed on the days of the window, or since the target's last change.

    Both start `lookback_days` earlier, for late rows. Without a target, or with
    an empty one, everything is read. Bounds are literals by the time the source
    is scanned, so they reach its files and partitions.
    """
    if window.given:
        if target is None:
            return source
        first, end = day_bounds(window.start, window.end, lookback_days)
        return source.filter(_day_filter(modified, first, end))
    if target is None:
        return source
    last = watermark(target, target_modified or modified)
    if last is None:
        return source
    first = F.date_sub(F.lit(last).cast("date"), lookback_days)
    return source.filter(_day_filter(modified, first))


def changed_since(
    source: DataFrame,
    modified: str,
    window: RunWindow,
    target: DataFrame | None = None,
    lookback_days: int = 1,
) -> DataFrame:
    """The clean layer's window: compares time stamps rather than days."""
    if target is None:
        return source
    if window.given:
        first, end = day_bounds(window.start, window.end, lookback_days)
        at = F.col(modified)
        return source.filter((at >= first.cast("timestamp")) & (at < end.cast("timestamp")))
    last = watermark(target, modified)
    if last is None:
        return source
    back = F.make_dt_interval(days=F.lit(lookback_days))
    return source.filter(F.col(modified) >= F.lit(last).cast("timestamp") - back)


def watermark(df: DataFrame, column: str) -> str | None:
    """Greatest value of a time column, as text: the one value a run needs first."""
    return df.agg(F.max(column).cast("string")).first()[0]


def _day_filter(modified: str, first: Column, end: Column | None = None) -> Column:
    """Days [first, end) as bounds on the time stamp itself, which files can skip by."""
    condition = F.col(modified) >= first.cast("timestamp")
    if end is not None:
        condition = condition & (F.col(modified) < end.cast("timestamp"))
    return condition


def all_rows_of_changed(source: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """Every row, old or new, of the keys that occur in `changed`."""
    return rows_of(source, changed, keys)
