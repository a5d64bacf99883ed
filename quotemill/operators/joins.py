"""Equi-joins. Sides are broadcast by Spark where their size allows; none is forced."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import norm_publisher, norm_symbol
from .aggregations import dedupe_active_assets


def join_bars_assets(bars: DataFrame, assets: DataFrame) -> DataFrame:
    """Bars of active symbols with the smallest asset_id of each symbol; bars keep their spelling."""
    ids = dedupe_active_assets(assets).withColumnsRenamed({"symbol": "_symbol"})
    return bars.drop("asset_id").join(ids, norm_symbol("symbol") == F.col("_symbol")).drop("_symbol")


def join_news_dims(news: DataFrame, assets: DataFrame, publishers: DataFrame) -> DataFrame:
    """Add asset_id and publisher_id (null where unknown). Assets that share a symbol multiply the row."""
    a = assets.select("asset_id", F.upper("symbol").alias("_symbol"))
    p = publishers.select("publisher_id", F.col("publisher_name_norm").alias("_publisher"))
    return news.join(a, F.upper("symbol") == F.col("_symbol"), "left").join(p, norm_publisher("publisher") == F.col("_publisher"), "left").drop("_symbol", "_publisher")


def join_fallback(rows: DataFrame, assets: DataFrame, symbol: str = "symbol", name: str = "company_name") -> DataFrame:
    """Add asset_id by symbol, and only where that missed by lower-cased name."""
    by_symbol = assets.select(F.col("asset_id").alias("_id1"), norm_symbol("symbol").alias("_symbol"))
    by_name = assets.select(F.col("asset_id").alias("_id2"), F.lower(F.trim("name")).alias("_name"))
    first = rows.join(by_symbol, norm_symbol(symbol) == F.col("_symbol"), "left")
    both = first.join(by_name, F.col("_id1").isNull() & (F.lower(F.trim(name)) == F.col("_name")), "left")
    return both.withColumn("asset_id", F.coalesce("_id1", "_id2")).drop("_id1", "_id2", "_symbol", "_name")


def join_final_features(daily: DataFrame, features: DataFrame, on: tuple[str, ...] = ("asset_id", "symbol", "trade_date")) -> DataFrame:
    """Daily rows with their window features. Prefer to carry the daily columns through the window."""
    extra = [c for c in features.columns if c in on or c not in daily.columns]
    return daily.join(features.select(*extra), list(on), "left")


def join_sentiment(prices: DataFrame, sentiment: DataFrame | None, on: tuple[str, ...] = ("asset_id",)) -> DataFrame:
    """Attach sentiment_score; a null column where there is no sentiment table."""
    if sentiment is None:
        return prices.withColumn("sentiment_score", F.lit(None).cast("double"))
    return prices.drop("sentiment_score").join(sentiment.select(*on, "sentiment_score"), list(on), "left")


def join_publisher_weight(headlines: DataFrame, publishers: DataFrame) -> DataFrame:
    """Headlines whose publisher has a weight."""
    weights = publishers.where(F.col("publisher_weight").isNotNull()).select("publisher_id", "publisher_weight")
    return headlines.join(weights, "publisher_id")


def semi_target_assets(df: DataFrame, targets: DataFrame, on: str = "asset_id") -> DataFrame:
    return df.join(targets.select(on).distinct(), on, "left_semi")


def anti_missing_symbols(active: DataFrame, present: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Normalized active symbols without a row in `present`."""
    have = present.select(norm_symbol(symbol).alias(symbol))
    return active.select(norm_symbol(symbol).alias(symbol)).distinct().join(have, symbol, "left_anti")


def anti_new_publishers(names: DataFrame, existing: DataFrame, name: str = "publisher") -> DataFrame:
    """Distinct normalized names that aren't registered."""
    new = names.select(F.col(name).alias("publisher_name"), norm_publisher(name).alias("publisher_name_norm")).where("publisher_name_norm <> ''")
    one = new.groupBy("publisher_name_norm").agg(F.min("publisher_name").alias("publisher_name"))
    return one.join(existing.select("publisher_name_norm"), "publisher_name_norm", "left_anti").select("publisher_name", "publisher_name_norm")


def merge_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row: inserted, updated, deleted. Null keys match null keys."""
    values = [c for c in new.columns if c not in keys and c in old.columns]
    side = lambda df, tag: df.select(*[F.col(k).alias(f"{tag}_{k}") for k in keys], F.struct(*[F.col(v) for v in values] or [F.lit(1)]).alias(f"{tag}_row"), F.lit(True).alias(f"{tag}_in"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}"))
    joined = side(old, "o").join(side(new, "n"), same, "full")
    changed = F.col("o_in") & F.col("n_in") & ~F.col("o_row").eqNullSafe(F.col("n_row"))
    return joined.agg(F.count_if(F.col("o_in").isNull()).alias("inserted"), F.count_if(changed).alias("updated"), F.count_if(F.col("n_in").isNull()).alias("deleted"))


def join_symbols_names(prices: DataFrame, assets: DataFrame) -> DataFrame:
    """Distinct price symbols with their names."""
    names = assets.groupBy(norm_symbol("symbol").alias("_symbol")).agg(F.min("name").alias("name"))
    return prices.select("symbol").where(F.trim("symbol") != "").distinct().join(names, norm_symbol("symbol") == F.col("_symbol"), "left").drop("_symbol")


def join_sp500_assets(constituents: DataFrame, assets: DataFrame) -> DataFrame:
    ids = assets.groupBy(norm_symbol("symbol").alias("_symbol")).agg(F.min("asset_id").alias("asset_id"))
    return constituents.drop("asset_id").join(ids, norm_symbol("symbol") == F.col("_symbol"), "left").drop("_symbol")


def join_rank(publishers: DataFrame, ranks: DataFrame, worst: bool = True) -> DataFrame:
    """Add the rank of the publisher's domain: of a base domain's ranks the largest (as the last row of a sorted list), or the smallest."""
    from ..functions.columns import base_domain

    folded = ranks.groupBy(base_domain("domain").alias("publisher_domain")).agg((F.max if worst else F.min)("rank").alias("rank"))
    return publishers.drop("rank").join(folded.where("publisher_domain <> ''"), "publisher_domain", "left")


def null_safe_update_join(target: DataFrame, scores: DataFrame) -> DataFrame:
    """Write `sentiment` back by four text keys (null equals '') and two timestamps (null never matches)."""
    text, times = ["symbol", "uuid", "link", "title"], ["provider_publish_time", "ingested_ts"]
    keyed = scores.select(*[F.coalesce(c, F.lit("")).alias(f"_{c}") for c in text], *[F.col(c).alias(f"_{c}") for c in times], F.col("sentiment").alias("_sentiment"), F.lit(True).alias("_hit"))
    one = keyed.groupBy(*[f"_{c}" for c in text + times]).agg(F.min("_sentiment").alias("_sentiment"), F.first("_hit").alias("_hit"))
    on = F.lit(True)
    for c in text:
        on = on & (F.coalesce(target[c], F.lit("")) == F.col(f"_{c}"))
    for c in times:
        on = on & (target[c] == F.col(f"_{c}"))
    joined = target.join(one, on, "left")
    return joined.withColumn("sentiment", F.when(F.col("_hit"), F.col("_sentiment")).otherwise(F.col("sentiment"))).drop(*[f"_{c}" for c in text + times], "_sentiment", "_hit")
