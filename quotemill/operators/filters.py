"""Projections and filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HORIZONS = {"1M": 31, "3M": 92, "1Y": 366, "3Y": 1096, "5Y": 1826}


def rename_known(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns that are present."""
    return df.withColumnsRenamed(mapping)


def reorder_columns(df: DataFrame, first: list[str]) -> DataFrame:
    """Known columns first, the others behind in their order."""
    known = [c for c in first if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


def filter_active(assets: DataFrame, active: str = "is_active", symbol: str = "symbol") -> DataFrame:
    return assets.where(F.col(active) & (F.trim(symbol) != ""))


def filter_not_null_set(df: DataFrame, cols: list[str], symbol: str | None = None, symbol_column: str = "symbol") -> DataFrame:
    kept = df.dropna(subset=cols)
    return kept if symbol is None else kept.where(F.upper(symbol_column) == symbol.upper())


def filter_date_range(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows of [start, end)."""
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def filter_in_list(df: DataFrame, column: str, values) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def filter_failure_or_message(runs: DataFrame, status: str = "status", message: str = "error_message") -> DataFrame:
    return runs.where((F.col(status) == "FAILURE") | (F.trim(message) != ""))


def latest_slice(df: DataFrame, date: str = "trade_date") -> DataFrame:
    """Rows of the newest date; one row is broadcast."""
    newest = df.agg(F.max(date).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(date) == F.col("_newest")).drop("_newest")


def horizon_filter(df: DataFrame, horizon: str, date: str = "trade_date", by: str = "symbol") -> DataFrame:
    """Rows within the horizon's days of their series' newest date; an unknown horizon keeps all."""
    if horizon not in HORIZONS:
        return df
    newest = df.groupBy(by).agg(F.max(date).alias("_newest"))
    joined = df.join(newest, by)
    return joined.where(F.col(date) >= F.date_sub("_newest", HORIZONS[horizon])).drop("_newest")


def trailing_30d_by_coalesced_ts(runs: DataFrame, now: datetime, end: str = "end_time", logged: str = "logged_ts") -> DataFrame:
    return runs.where(F.coalesce(end, logged) >= F.lit(now) - F.expr("INTERVAL 30 DAYS"))


def observed_at(end: str = "end_time", logged: str = "logged_ts") -> Column:
    return F.coalesce(end, logged)
