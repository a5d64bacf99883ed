"""Aggregations; each is one shuffle on its keys after a partial aggregate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import window_bounds
from ..functions.columns import col, fields_int, metadata_fields, norm_publisher, norm_symbol, sentiment_value

#: Names under which a run's counts are reported, the canonical one first (fixed values).
METRIC_KEYS = {
    "row_count": ("row_count",),
    "rows_inserted": ("rows_inserted", "inserted_count"),
    "rows_updated": ("rows_updated", "updated_count"),
    "rows_deleted": ("rows_deleted", "deleted_count"),
}


def vwap(price: str, volume: str) -> Column:
    """Aggregate: volume-weighted mean of the rows with both; null unless their volume is above 0."""
    both = F.col(price).isNotNull() & F.col(volume).isNotNull()
    total = F.sum(F.when(both, F.col(volume)))
    return F.when(total > 0, F.try_divide(F.sum(F.when(both, F.col(price) * F.col(volume))), total))


def daily_ohlc(bars: DataFrame, by: tuple[str, ...] = ("asset_id", "symbol"), ts: str = "timestamp") -> DataFrame:
    """Open, high, low, close, volume, trades and vwap of each day; first and last skip null values."""
    first = F.min_by("open", F.when(F.col("open").isNotNull(), F.col(ts)))
    last = F.max_by("close", F.when(F.col("close").isNotNull(), F.col(ts)))
    return bars.groupBy(*by, F.col(ts).cast("date").alias("trade_date")).agg(
        first.alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), last.alias("close"),
        F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count"), vwap("vwap", "volume").alias("vwap"),
    )


def dedupe_active_assets(assets: DataFrame) -> DataFrame:
    """One asset_id, the smallest, for each normalized active symbol."""
    active = assets.where(F.col("is_active") & (F.trim("symbol") != ""))
    return active.groupBy(norm_symbol("symbol").alias("symbol")).agg(F.min("asset_id").alias("asset_id"))


def weighted_sentiment_7d(headlines: DataFrame, publishers: DataFrame, as_of: date, ts: str = "provider_publish_time") -> DataFrame:
    """Publisher-weighted mean sentiment of each asset over the 7 days to `as_of`; no eligible headline, no row."""
    start, end = window_bounds(as_of, 7)
    weights = publishers.where("publisher_weight > 0").select("publisher_id", "publisher_weight")
    rows = headlines.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)) & F.col("asset_id").isNotNull())
    rows = rows.withColumn("_value", sentiment_value("sentiment")).where(F.col("_value").isNotNull()).join(weights, "publisher_id")
    return rows.groupBy("asset_id").agg(F.try_divide(F.sum(F.col("_value") * F.col("publisher_weight")), F.sum("publisher_weight")).alias("sentiment_score"))


def publisher_domain_mode(news: DataFrame, publisher: str = "publisher", domain: str = "domain") -> DataFrame:
    """Most frequent domain of each publisher; of equals the first by name."""
    counts = news.where(F.trim(domain) != "").groupBy(norm_publisher(publisher).alias("publisher_name_norm"), F.col(domain).alias("domain")).count()
    best = F.min(F.struct((-F.col("count")).alias("k"), "domain"))
    return counts.groupBy("publisher_name_norm").agg(best["domain"].alias("publisher_domain"))


def distinct_symbols(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    return df.select(norm_symbol(symbol).alias("symbol")).where("symbol <> ''").distinct()


def count_distinct_assets(df: DataFrame, value: str = "views") -> DataFrame:
    return df.where(F.col(value).isNotNull()).agg(F.countDistinct("asset_id").alias("n_assets"))


def conditional_counts(df: DataFrame, null_cols: list[str]) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in null_cols])


def excess_duplicates(df: DataFrame, keys: list[Column | str]) -> DataFrame:
    """One row: how many rows repeat an earlier key."""
    groups = df.groupBy(*[col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).count()
    return groups.where("count > 1").agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("excess"))


def null_profile(df: DataFrame, cols: list[str], blank_cols: tuple[str, ...] = ()) -> DataFrame:
    """One row: null (or blank) count and share of each column, the rows, and the largest share; shares of no rows are 0."""
    missing = {c: F.col(c).isNull() | (F.trim(c) == "") if c in blank_cols else F.col(c).isNull() for c in cols}
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(m).alias(f"null_{c}") for c, m in missing.items()])
    shares = {c: F.coalesce(F.try_divide(F.col(f"null_{c}"), F.col("rows")), F.lit(0.0)) for c in cols}
    most = F.greatest(*shares.values()) if len(cols) > 1 else shares[cols[0]]
    return counts.select("rows", *[f"null_{c}" for c in cols], *[s.alias(f"share_{c}") for c, s in shares.items()], most.alias("max_share"))


def range_violations(df: DataFrame, rules: list[Column]) -> DataFrame:
    """One row: how many rows break any rule; a null operand breaks none."""
    broken = F.lit(False)
    for rule in rules:
        broken = broken | F.coalesce(rule, F.lit(False))
    return df.agg(F.count_if(broken).alias("violations"))


def market_breadth(day: DataFrame) -> DataFrame:
    """Shares of rising assets and of those above their averages, in percent, over rows with a return; rows without a close or an average don't count for its share, which is null where none has one."""
    rows = day.where(F.col("returns_1d").isNotNull())
    share = lambda c: F.avg(F.when(c, 100.0).when(~c, 0.0))
    above = lambda n: share(F.col("close") > F.col(f"sma_{n}"))
    return rows.agg(share(F.col("returns_1d") > 0).alias("pct_up"), above(50).alias("pct_above_sma_50"), above(200).alias("pct_above_sma_200"), F.count("*").alias("universe"))


def concentration_impact(day: DataFrame, symbols: set[str]) -> DataFrame:
    """Share of |return x dollar volume| that a set of symbols has; null where there is none."""
    impact = F.abs(F.col("returns_1d") * F.col("dollar_volume"))
    rows = day.where("dollar_volume > 0").withColumn("_impact", impact)
    total = F.sum("_impact")
    mine = F.sum(F.when(F.upper("symbol").isin(sorted(symbols)), F.col("_impact")).otherwise(0.0))
    return rows.agg(F.when(total > 0, F.try_divide(mine, total)).alias("impact_share"))


def series_extents(df: DataFrame, cols: list[str], pad_frac: float, pad_min: float, by: str | None = None) -> DataFrame:
    """Least and largest of all columns, padded by a fraction of their range or a least amount."""
    low = F.least(*[F.min(c) for c in cols]) if len(cols) > 1 else F.min(cols[0])
    high = F.greatest(*[F.max(c) for c in cols]) if len(cols) > 1 else F.max(cols[0])
    ends = (df.groupBy(by) if by else df.groupBy()).agg(low.alias("lo"), high.alias("hi"))
    pad = F.greatest((F.col("hi") - F.col("lo")) * pad_frac, F.lit(pad_min))
    return ends.select(*([by] if by else []), (F.col("lo") - pad).alias("domain_low"), (F.col("hi") + pad).alias("domain_high"))


def asset_metrics_rollup(events: DataFrame, by: tuple[str, ...] = ("run_id", "job_name", "asset_key"), json: str = "metadata_json") -> DataFrame:
    """Events, reported rows (null when never reported) and changed rows (0 when absent) of each asset."""
    parsed = events.select(*by, metadata_fields(json).alias("_fields"))
    values = parsed.select(*by, *[fields_int(F.col("_fields"), *names).alias(k) for k, names in METRIC_KEYS.items()])
    changed = [F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in METRIC_KEYS if k != "row_count"]
    return values.groupBy(*by).agg(F.count("*").alias("assets_materialized_count"), F.sum("row_count").alias("row_count"), *changed)


def run_metrics_rollup(asset_metrics: DataFrame, by: tuple[str, ...] = ("run_id", "job_name")) -> DataFrame:
    return asset_metrics.groupBy(*by).agg(*[F.sum(k).alias(k) for k in ("assets_materialized_count", *METRIC_KEYS)])


def run_duration(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Start and end of each run (its events' where not given) and the seconds between."""
    seen = events.groupBy("run_id").agg(F.min("event_ts").alias("_first"), F.max("event_ts").alias("_last"))
    rows = runs.join(seen, "run_id", "left").withColumns({"start_time": F.coalesce("start_time", "_first"), "end_time": F.coalesce("end_time", "_last")})
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return rows.withColumn("duration_seconds", (micros("end_time") - micros("start_time")) / 1e6).drop("_first", "_last")


def mode_first(df: DataFrame, by: str, value: str) -> DataFrame:
    """Most frequent value of each group; of equals the first."""
    ranked = df.groupBy(by, value).count().withColumn("_k", F.row_number().over(W.partitionBy(by).orderBy(F.desc("count"), value)))
    return ranked.where("_k = 1").select(by, value)
