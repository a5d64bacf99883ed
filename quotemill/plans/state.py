"""Daily factors from a stored state: one row for each asset, with the closes of its last 252 rows.

A day's factors need the closes of at most 252 rows before it, however long ago those lie.
The state table holds them as a ring, so a day reads one row of each of its assets instead
of a window of days, and equals the backfill without a condition on dates. The table is
versioned: each day commits a new version on top of the one it read, and `as_of` in it
names the last day that it holds.

A state that isn't of the last stored day (a crash between the two writes, a day built by
other means, none yet) is made anew from the stored rows. Bars that come in late, for a
day before the last, are replayed: the day and the later rows of its assets, of which the
next 252 can change, are computed from the state before it, and the state is made anew.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import dollar_volume
from ..operators.aggregations import daily_ohlc, market_breadth, weighted_sentiment_7d
from ..operators.joins import join_sentiment, semi_target_assets
from ..operators.windows import all_factors, tiled_sum
from ..sources.readers import scan_silver_day, scan_snapshot_as_of, scan_snapshot_latest, table_exists
from ..sources.versions import Snapshot, load, snapshot
from .prices import GOLD_COLUMNS, Paths

#: Rows of a ring: the longest window.
RING = 252
STATE = "asset_id long, ring array<struct<trade_date: date, close: double>>, as_of date"
FACTORS = ["dollar_volume", "returns_1d", "returns_5d", "returns_21d", "realized_vol_21d", "momentum_12_1", "pct_below_52w_high", "sma_50", "sma_200", "dist_sma_50", "dist_sma_200"]


def build_state(prices: DataFrame, as_of: date | None) -> DataFrame:
    """The state after the rows of `prices` (asset_id, trade_date, close)."""
    last = F.row_number().over(W.partitionBy("asset_id").orderBy(F.desc("trade_date")))
    rows = prices.select("asset_id", "trade_date", "close").withColumn("n", last).where(F.col("n") <= RING)
    ring = F.array_sort(F.collect_list(F.struct("trade_date", "close")))
    return rows.groupBy("asset_id").agg(ring.alias("ring")).select("asset_id", "ring", F.lit(as_of).cast("date").alias("as_of"))


def _welford(values: Column) -> Column:
    """Sample deviation of an array in one pass; null values don't count, less than two give null."""
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a, x):
        delta = x - a["mean"]
        step = delta / (a["n"] + 1)
        return F.struct((a["n"] + 1).alias("n"), (a["mean"] + step).alias("mean"), (a["m2"] + delta * (delta - step)).alias("m2"))

    return F.aggregate(F.filter(values, lambda x: x.isNotNull()), zero, add, lambda a: F.when(a["n"] > 1, F.sqrt(a["m2"] / (a["n"] - 1))))


def state_factors(today: DataFrame, state: DataFrame) -> DataFrame:
    """Factors of one day's rows (one an asset) from the state before it; the same values as over windows of all rows."""
    none = F.expr("CAST(array() AS array<double>)")
    rows = today.join(state.select("asset_id", F.transform("ring", lambda r: r["close"]).alias("_old")), "asset_id", "left")
    rows = rows.withColumn("_all", F.concat(F.coalesce("_old", none), F.array("close"))).withColumn("_size", F.size("_all"))
    back = lambda k: F.when(F.col("_size") > k, F.element_at("_all", -1 - k))
    tail = lambda n: F.slice("_all", F.greatest(F.col("_size") - n + 1, F.lit(1)), n)

    def mean(n):
        # rows that aren't there stand as 0 in front, as they do in the windows' tiles
        full = F.concat(F.array_repeat(F.lit(0.0), n - F.size(tail(n))), F.transform(tail(n), lambda x: F.coalesce(x, F.lit(0.0))))
        return F.try_divide(tiled_sum(full, n), F.size(F.filter(tail(n), lambda x: x.isNotNull())))

    returns = lambda k: F.try_divide(F.col("close"), back(k)) - 1
    # the last 21 returns need 22 closes
    pairs = F.zip_with(F.slice(tail(22), 2, 21), tail(22), lambda x, y: F.when(x.isNotNull(), F.try_divide(x, y) - 1))
    high = F.array_max(tail(RING))
    close = F.col("close")
    rows = rows.withColumns({
        "dollar_volume": dollar_volume("close", "volume"), **{f"returns_{k}d": returns(k) for k in (1, 5, 21)},
        "realized_vol_21d": _welford(pairs) * F.sqrt(F.lit(252.0)), "momentum_12_1": F.try_divide(back(21), back(252)) - 1,
        "pct_below_52w_high": F.try_divide(high - close, high), "sma_50": mean(50), "sma_200": mean(200),
    })
    return rows.withColumns({f"dist_sma_{n}": F.try_divide(close, F.col(f"sma_{n}")) - 1 for n in (50, 200)}).drop("_old", "_all", "_size")


def day_factors(daily: DataFrame, as_of: date) -> DataFrame:
    """The rows of one day of `daily` with every factor, without factors of other days.

    The bound on the date and the day's assets reach the rows before they are grouped; of
    the history only the last 252 closes of each of these assets are kept.
    """
    today = daily.where(F.col("trade_date") == F.lit(as_of))
    before = semi_target_assets(daily.where(F.col("trade_date") < F.lit(as_of)), today)
    return state_factors(today, build_state(before, as_of))


def stored_breadth(spark: SparkSession, paths: Paths, as_of: date | None = None) -> DataFrame:
    """Market breadth of the newest stored day (not after `as_of`); one partition of `gold/prices_by_state` is read."""
    root = paths.table("gold", "prices_by_state")
    return market_breadth(scan_snapshot_latest(spark, root, "trade_date") if as_of is None else scan_snapshot_as_of(spark, root, as_of, "trade_date"))


def next_state(state: DataFrame, today: DataFrame, as_of: date) -> DataFrame:
    """The state with the day's closes pushed into the rings; other assets' rings stay."""
    none = F.expr("CAST(array() AS array<struct<trade_date: date, close: double>>)")
    new = today.select("asset_id", F.array(F.struct("trade_date", "close")).alias("_new"))
    rings = state.select("asset_id", "ring").join(new, "asset_id", "full").select("asset_id", F.concat(F.coalesce("ring", none), F.coalesce("_new", none)).alias("ring"))
    return rings.select("asset_id", F.slice("ring", F.greatest(F.size("ring") - RING + 1, F.lit(1)), RING).alias("ring"), F.lit(as_of).cast("date").alias("as_of"))


def replayed(state: DataFrame, rows: DataFrame) -> DataFrame:
    """Factors of daily rows of any days, all after those of the state, over windows that begin with its rings."""
    old = state.select("asset_id", F.explode("ring").alias("r")).select("asset_id", "r.trade_date", "r.close", F.lit(True).alias("_old"))
    both = old.unionByName(rows.drop(*FACTORS).withColumn("_old", F.lit(False)), allowMissingColumns=True).withColumn("dollar_volume", dollar_volume("close", "volume"))
    return all_factors(both).where("NOT _old").drop("_old")


def _gold_days(gold: Snapshot) -> list[str]:
    return gold.values() if gold.exists() else []


def _state_before(spark: SparkSession, table: Snapshot, gold: Snapshot, as_of: date) -> DataFrame:
    """The stored state if it is of the last stored day before `as_of`, else one made from the stored rows."""
    before = [d for d in _gold_days(gold) if d < as_of.isoformat()]
    held = table.read().agg(F.max("as_of")).first()[0] if table.exists() else None
    if before and held is not None and held.isoformat() == before[-1]:
        return table.read()
    if not before:
        return spark.createDataFrame([], STATE)
    return build_state(gold.read(None, as_of), date.fromisoformat(before[-1]))


def gold_prices_stateful(spark: SparkSession, paths: Paths, as_of: date) -> tuple[int, int]:
    """Build and replace one day of `gold/prices_by_state` from the state; gives (rows of the day, rows replaced). Later rows of its assets are replayed."""
    gold, table = (snapshot(spark, paths.table("gold", n)) for n in ("prices_by_state", "price_state"))
    end = as_of + timedelta(days=1)
    active = load(spark, paths.table("silver", "assets")).where("is_active").select("asset_id")
    bars = daily_ohlc(scan_silver_day(spark, paths.table("silver", "prices"), as_of))
    today = semi_target_assets(bars.where(F.col("trade_date") == F.lit(as_of)), active)
    state = _state_before(spark, table, gold, as_of)
    sentiment = None
    if table_exists(spark, paths.table("gold", "headlines")) and table_exists(spark, paths.table("silver", "publishers")):
        sentiment = weighted_sentiment_7d(load(spark, paths.table("gold", "headlines")), load(spark, paths.table("silver", "publishers")), as_of)
    day = join_sentiment(state_factors(today, state), sentiment).select(*GOLD_COLUMNS)
    deleted = gold.between("trade_date", as_of, end).count() if as_of.isoformat() in _gold_days(gold) else 0
    later = [d for d in _gold_days(gold) if d >= end.isoformat()]
    if not later:
        done = gold.replace_parts(day, "trade_date", also=(as_of,))
        stored = done.between("trade_date", as_of, end)
        table.replace(next_state(state, stored, as_of))
        return stored.count(), deleted
    # late bars: later rows of the day's assets, before and now, see another past
    after = gold.read(end, None)
    touched = day.select("asset_id").union(gold.between("trade_date", as_of, end).select("asset_id")).distinct()
    moved = after.join(touched, "asset_id", "left_semi").select(*GOLD_COLUMNS)
    again = replayed(state, day.select(*GOLD_COLUMNS).unionByName(moved)).where(F.col("trade_date") > F.lit(as_of)).select(*GOLD_COLUMNS)
    rest = after.join(touched, "asset_id", "left_anti").select(*GOLD_COLUMNS)
    done = gold.replace_parts(day.unionByName(again).unionByName(rest), "trade_date", also=(as_of,))
    table.replace(build_state(done.read(), date.fromisoformat(later[-1])))
    return done.between("trade_date", as_of, end).count(), deleted

