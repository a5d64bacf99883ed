"""Calendar and window bounds."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .columns import col


def parse_key(key: Column | str) -> Column:
    """A `yyyy-MM-dd` key as a date; null where it can't be read."""
    return F.to_date(F.try_to_timestamp(col(key).cast("string"), F.lit("yyyy-MM-dd")))


def is_weekday(day: Column | str) -> Column:
    """False for weekends and for keys that can't be read."""
    return F.coalesce(~F.dayofweek(parse_key(day)).isin(1, 7), F.lit(False))


def is_trading_day(df: DataFrame, day: str, holidays: DataFrame | None = None, out: str = "is_trading_day") -> DataFrame:
    """Add whether `day` is a weekday and not in `holidays` (column `date`)."""
    if holidays is None:
        return df.withColumn(out, is_weekday(day))
    closed = holidays.select(F.col("date").cast("date").alias("_closed")).distinct()
    joined = df.join(closed, parse_key(day) == F.col("_closed"), "left")
    return joined.withColumn(out, is_weekday(day) & F.col("_closed").isNull()).drop("_closed")


def previous_trading_day(dates: DataFrame, holidays: DataFrame | None = None, day: str = "date", reach: int = 15) -> DataFrame:
    """Add the newest trading day strictly before `day`, looking back `reach` days."""
    days = dates.select(F.col(day).cast("date").alias("_day")).distinct()
    back = days.select("_day", F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("_k")).select("_day", F.date_sub("_day", F.col("_k")).alias("_before"))
    open_ = is_trading_day(back, "_before", holidays, "_open").where("_open")
    found = open_.groupBy("_day").agg(F.max("_before").alias("previous_trading_day"))
    return dates.join(found, F.col(day).cast("date") == F.col("_day"), "left").drop("_day")


def month_start(day: Column | str) -> Column:
    return F.trunc(col(day), "MM").cast("date")


def window_bounds(as_of: date, days: int) -> tuple[date, date]:
    """[as_of - (days - 1), as_of + 1) as dates."""
    return as_of - timedelta(days=days - 1), as_of + timedelta(days=1)


def last_known(order: str, value: str, by: list[str]) -> Column:
    """The newest non-null value before the row."""
    return F.last(value, ignorenulls=True).over(W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
