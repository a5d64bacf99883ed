"""Sorted views and top-k; every order ends with a unique key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .windows import zscore


def _top(df: DataFrame, c: str, k: int, descending: bool, tie: str = "symbol") -> DataFrame:
    order = F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()
    return df.orderBy(order, F.col(tie)).limit(k)


def top_gainers_losers(day: DataFrame, k: int = 5) -> DataFrame:
    """k highest positive and k lowest negative daily returns."""
    up = _top(day.where("returns_1d > 0"), "returns_1d", k, True).withColumn("side", F.lit("gainer"))
    down = _top(day.where("returns_1d < 0"), "returns_1d", k, False).withColumn("side", F.lit("loser"))
    return up.unionByName(down)


def top_gainers_losers_by_date(prices: DataFrame, k: int = 5, date: str = "trade_date", tie: str = "symbol") -> DataFrame:
    """The same for each date."""
    up = F.row_number().over(W.partitionBy(date).orderBy(F.col("returns_1d").desc_nulls_last(), tie))
    down = F.row_number().over(W.partitionBy(date).orderBy(F.col("returns_1d").asc_nulls_last(), tie))
    ranked = prices.withColumns({"_up": up, "_down": down})
    high = ranked.where((F.col("_up") <= k) & (F.col("returns_1d") > 0)).withColumn("side", F.lit("gainer"))
    low = ranked.where((F.col("_down") <= k) & (F.col("returns_1d") < 0)).withColumn("side", F.lit("loser"))
    return high.unionByName(low).drop("_up", "_down")


def risky_bets(day: DataFrame, k: int = 6) -> DataFrame:
    """Buckets of assets with a volatility: hot (highest 21-day gains), crash (deepest losses), sleepy (least volatile)."""
    rows = day.where(F.col("realized_vol_21d").isNotNull())
    hot = _top(rows.where("returns_21d > 0"), "returns_21d", k, True).withColumn("bucket", F.lit("hot"))
    crash = _top(rows.where("returns_21d < 0"), "returns_21d", k, False).withColumn("bucket", F.lit("crash"))
    sleepy = _top(rows, "realized_vol_21d", k, False).withColumn("bucket", F.lit("sleepy"))
    return hot.unionByName(crash).unionByName(sleepy)


def underrated(day: DataFrame, k: int = 6) -> DataFrame:
    """Largest sums of the z-scores of momentum and of the distance below the 52-week high."""
    cols = ["momentum_12_1", "pct_below_52w_high"]
    scored = zscore(day.dropna(subset=cols), cols).withColumn("score", F.col("z_momentum_12_1") + F.col("z_pct_below_52w_high"))
    return _top(scored, "score", k, True)


def sentiment_movers(day: DataFrame, k: int = 5, ascending: bool = False) -> DataFrame:
    """k highest (or lowest) sentiment scores; shown x100 where none of them passes 1.5."""
    shown = _top(day.where(F.col("sentiment_score").isNotNull()), "sentiment_score", k, not ascending)
    most = F.max(F.abs("sentiment_score")).over(W.partitionBy(F.lit(1)))
    return shown.withColumn("shown_score", F.when(most <= 1.5, F.col("sentiment_score") * 100).otherwise(F.col("sentiment_score")))


def sentiment_label(c: str = "sentiment") -> Column:
    label = F.lower(F.trim(c))
    return F.when(label.isin("positive", "negative"), label).otherwise("neutral")


def recent_headlines(headlines: DataFrame, symbol: str, k: int = 50, tie: str = "uuid") -> DataFrame:
    rows = headlines.where(F.upper("symbol") == symbol.upper()).withColumn("sentiment", sentiment_label())
    return rows.orderBy(F.col("provider_publish_time").desc_nulls_last(), F.col(tie).asc_nulls_last()).limit(k)


def recent_rows(log: DataFrame, k: int, where: Column | None = None, tie: str = "run_id") -> DataFrame:
    rows = log if where is None else log.where(where)
    return rows.orderBy(F.coalesce("end_time", "logged_ts").desc_nulls_last(), F.col(tie)).limit(k)


def missing_symbol_sample(missing: DataFrame, k: int = 25) -> DataFrame:
    """The first k symbols as one sorted list, and how many there are."""
    first = missing.orderBy("symbol").limit(k).agg(F.sort_array(F.collect_list("symbol")).alias("sample"))
    return missing.agg(F.count("*").alias("missing_count")).join(F.broadcast(first))


def duration_trend(runs: DataFrame, job: str, k: int = 100) -> DataFrame:
    """The last k runs of a job in order of time, with minutes."""
    last = runs.where(F.col("job_name") == job).orderBy(F.col("start_time").desc_nulls_last(), "run_id").limit(k)
    return last.withColumn("duration_minutes", F.col("duration_seconds") / 60.0).orderBy(F.col("start_time").asc_nulls_last(), "run_id")
