"""Price jobs: silver bars, compaction, daily factors in full-history and one-day form."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import dollar_volume
from ..operators.aggregations import daily_ohlc, weighted_sentiment_7d
from ..operators.filters import reorder_columns
from ..operators.joins import join_bars_assets, join_sentiment, semi_target_assets
from ..operators.merges import union_history_today
from ..operators.windows import all_factors, momentum_12_1, pct_below_52w_high
from ..sources.readers import scan_day_range, scan_month, scan_silver_day, table_exists
from ..sources.sinks import replace_date_slice, sink_compact_month, sink_replace_day
from ..sources.versions import load


@dataclass
class Paths:
    """Roots of the layered tables."""

    root: str

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"


LOOKBACK_DAYS = 400
GOLD_COLUMNS = [f.name for f in schemas.GOLD_PRICES.fields]


def silver_bars(bars: DataFrame, assets: DataFrame) -> DataFrame:
    """Active bars with their asset_id, known columns first."""
    return reorder_columns(join_bars_assets(bars, assets), [f.name for f in schemas.SILVER_BARS.fields])


def silver_prices(spark: SparkSession, paths: Paths, as_of: date) -> None:
    bars = scan_day_range(spark, paths.table("bronze", "bars"), as_of)
    sink_replace_day(silver_bars(bars, load(spark, paths.table("silver", "assets"))), paths.table("silver", "prices"))


def compact_prices(spark: SparkSession, paths: Paths, month: date) -> None:
    sink_compact_month(scan_month(spark, paths.table("silver", "prices"), month).drop("date"), paths.table("silver", "prices_compact"))


def price_factors(daily: DataFrame) -> DataFrame:
    """Every factor of daily rows (unique per asset and date)."""
    rows = daily.withColumn("dollar_volume", dollar_volume("close", "volume"))
    return all_factors(rows)


def gold_prices_backfill(bars: DataFrame, sentiment: DataFrame | None = None) -> DataFrame:
    """All dates in one pass: daily rows, factors, and sentiment (asset_id, trade_date, sentiment_score)."""
    rows = price_factors(daily_ohlc(bars))
    return join_sentiment(rows, sentiment, ("asset_id", "trade_date")).select(*GOLD_COLUMNS)


def gold_day(bars: DataFrame, stored: DataFrame, as_of: date, active: DataFrame | None = None, sentiment: DataFrame | None = None) -> DataFrame:
    """One day's gold rows, with up to 400 days of stored closes as history."""
    today = daily_ohlc(bars).where(F.col("trade_date") == F.lit(as_of))
    if active is not None:
        today = semi_target_assets(today, active)
    history = semi_target_assets(stored.select("asset_id", "symbol", "trade_date", "close"), today)
    rows = price_factors(union_history_today(history, today, as_of, LOOKBACK_DAYS)).where(F.col("trade_date") == F.lit(as_of))
    return join_sentiment(rows, sentiment).select(*GOLD_COLUMNS)


def gold_prices_incremental(spark: SparkSession, paths: Paths, as_of: date) -> tuple[int, int]:
    """Build and replace one day; gives (rows, deleted)."""
    root = paths.table("gold", "prices")
    stored = spark.read.parquet(root) if table_exists(spark, root) else spark.createDataFrame([], schemas.GOLD_PRICES)
    stored = stored.where(F.col("trade_date") >= F.lit(as_of - timedelta(days=LOOKBACK_DAYS)))
    sentiment = None
    if table_exists(spark, paths.table("gold", "headlines")) and table_exists(spark, paths.table("silver", "publishers")):
        sentiment = weighted_sentiment_7d(load(spark, paths.table("gold", "headlines")), load(spark, paths.table("silver", "publishers")), as_of)
    active = load(spark, paths.table("silver", "assets")).where("is_active").select("asset_id")
    day = gold_day(scan_silver_day(spark, paths.table("silver", "prices"), as_of), stored, as_of, active, sentiment)
    return replace_date_slice(day, root, as_of)


def backfill_momentum(prices: DataFrame) -> DataFrame:
    """Fill momentum_12_1 where it is null."""
    filled = momentum_12_1(prices.withColumnRenamed("momentum_12_1", "_old"))
    return filled.withColumn("momentum_12_1", F.coalesce("_old", "momentum_12_1")).drop("_old").select(*prices.columns)


def backfill_pct_high(prices: DataFrame) -> DataFrame:
    """Compute pct_below_52w_high anew for every row."""
    return pct_below_52w_high(prices.drop("pct_below_52w_high")).select(*dict.fromkeys([*prices.columns, "pct_below_52w_high"]))


def symbol_snapshot(prices: DataFrame) -> DataFrame:
    """Latest row of every symbol: close, change, 5 and 21 day returns, volatility."""
    from ..operators.windows import previous_close_delta

    return previous_close_delta(prices).select("asset_id", "symbol", "trade_date", "close", "delta_pct", "returns_5d", "returns_21d", "realized_vol_21d")
