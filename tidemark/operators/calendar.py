"""Date dimension, seasonal factors and growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import day_suffix
from tidemark.functions.measures import money

HOLIDAY_SCHEMA = "holiday_date date, holiday_name string"


def days_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    bounds = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(bounds).alias("full_date"))


def date_dimension(days: DataFrame, holidays: DataFrame | None = None, fiscal_start: int = 10) -> DataFrame:
    """Date dimension over the distinct days of `full_date`."""
    d = F.col("full_date")
    year, month, quarter, day = F.year(d), F.month(d), F.quarter(d), F.day(d)
    weekday = F.weekday(d)
    quarter_start, year_start = F.trunc(d, "QUARTER"), F.trunc(d, "YEAR")
    offset = (month + F.lit(12 - fiscal_start)) % 12
    if holidays is None:
        holidays = days.sparkSession.createDataFrame([], HOLIDAY_SCHEMA)
    named = days.join(holidays.withColumnRenamed("holiday_date", "full_date"), "full_date", "left")
    is_holiday = F.col("holiday_name").isNotNull()
    columns: dict[str, Column] = {
        "date_key": F.date_format(d, "yyyyMMdd").cast("int"),
        "full_date": d,
        "year_number": year,
        "month_number": month,
        "day_of_month": day,
        "day_of_week_number": weekday,
        "day_of_week_name": F.date_format(d, "EEEE"),
        "day_of_week_short_name": F.date_format(d, "EEE"),
        "day_of_year": F.dayofyear(d),
        "iso_week_number": F.weekofyear(d),
        "iso_year": F.extract(F.lit("YEAROFWEEK"), d),
        "us_week_of_year": F.floor((F.dayofyear(d) - 1) / 7).cast("int") + 1,
        "month_name": F.date_format(d, "MMMM"),
        "month_short_name": F.date_format(d, "MMM"),
        "year_month_number": year * 100 + month,
        "year_month_name": F.concat(year.cast("string"), F.lit("-"), F.date_format(d, "MMMM")),
        "first_day_of_month": F.trunc(d, "MM"),
        "last_day_of_month": F.last_day(d),
        "days_in_month": F.day(F.last_day(d)),
        "quarter_number": quarter,
        "quarter_name": F.concat(F.lit("Q"), quarter.cast("string")),
        "year_quarter_number": year * 10 + quarter,
        "year_quarter_name": F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string")),
        "first_day_of_quarter": quarter_start,
        "last_day_of_quarter": F.date_sub(F.add_months(quarter_start, 3), 1),
        "first_day_of_year": year_start,
        "last_day_of_year": F.date_sub(F.add_months(year_start, 12), 1),
        "is_leap_year": F.day(F.last_day(F.make_date(year, F.lit(2), F.lit(1)))) == 29,
        "is_weekday": weekday < 5,
        "is_weekend": weekday >= 5,
        "is_holiday": is_holiday,
        "holiday_name": F.col("holiday_name"),
        "is_workday": (weekday < 5) & ~is_holiday,
        "day_suffix": day_suffix(day),
        "week_ending_date_saturday": F.date_add(d, F.lit(5) - weekday),
        "week_ending_date_sunday": F.date_add(d, F.lit(6) - weekday),
        "fiscal_year_number": year + (month >= fiscal_start).cast("int"),
        "fiscal_quarter_number": F.floor(offset / 3).cast("int") + 1,
        "fiscal_month_offset": offset,
    }
    return named.select(*[column.alias(name) for name, column in columns.items()])


def seasonal_factors(days: DataFrame, day: str, amount: str) -> DataFrame:
    """`days` with `factor`: the mean of its weekday times that of its ISO week, each against the mean of all days.

    Weeks 1 to 53 are counted as they are. The means are of a few rows each.
    """
    columns = days.columns
    parts = days.withColumns({"_weekday": F.weekday(day), "_week": F.weekofyear(day)})
    mean = (F.sum(amount).cast("double") / F.count(F.lit(1)))
    of_all = parts.agg(mean.alias("_all"))
    by = {name: parts.groupBy(name).agg(mean.alias(f"{name}_mean")) for name in ("_weekday", "_week")}
    joined = parts.join(F.broadcast(by["_weekday"]), "_weekday").join(F.broadcast(by["_week"]), "_week").join(F.broadcast(of_all), F.lit(True))
    return joined.select(*columns, (F.col("_weekday_mean") / F.col("_all") * (F.col("_week_mean") / F.col("_all"))).alias("factor"))


def mean_growth(events: DataFrame, keys: list[str], at: str, amount: str) -> DataFrame:
    """Per key: `days` from the first to the last day, and the mean daily `growth` of the running total between them.

    The total of the first day grows to that of all days; null where they are one day.
    """
    daily = events.groupBy(*keys, F.to_date(at).alias("_day")).agg(F.sum(money(amount)).alias("_sum"))
    seen = daily.groupBy(*keys).agg(
        F.datediff(F.max("_day"), F.min("_day")).alias("days"), F.min_by("_sum", "_day").cast("double").alias("_first"), F.sum("_sum").cast("double").alias("_all"))
    growth = F.pow(F.try_divide("_all", "_first"), F.try_divide(F.lit(1.0), F.col("days"))) - 1
    return seen.select(*keys, "days", growth.alias("growth"))
