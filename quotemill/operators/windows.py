"""Window features over one series per asset. Frames count rows, not days.

All factors share one partitioning and order, so a chain of them is one exchange and one sort.

Wide frames are tiled. A sliding frame of Spark reads all its rows again for each row; a
tiled one takes the value of a narrow frame and combines it with the same value some rows
back, level by level: 252 rows are six tiles of 42, these six of 7. So a row costs a few
lags a level, a number that grows with the logarithm of the width. The value depends on the
frame's rows alone, to the last bit, wherever the series begins. Null values don't count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import dedupe_key
from ..sources.scratch import scratch_path

BY, ORDER = "asset_id", "trade_date"


def _w(by: str = BY, order: str = ORDER):
    return W.partitionBy(by).orderBy(order)


def _last(n: int, by: str = BY, order: str = ORDER):
    return _w(by, order).rowsBetween(1 - n, 0)


#: Rows of a table that one task gets in `deal_series`.
TASK_ROWS = 250_000


def deal_series(df: DataFrame, by: str = BY) -> DataFrame:
    """The rows of each series together, over more partitions the more rows there are, so that a task's memory doesn't grow with the table.

    Aggregates by more keys and windows over `by` that follow need no other exchange. The
    rows are counted first, which of a Parquet table reads its footers alone.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(usual, -(-df.count() // TASK_ROWS)), by)


#: Tiles a level, and the widest frame that is read whole.
TILES, NARROW = 6, 8


def _tiles(n: int) -> list[tuple[int, int]]:
    """Levels of a frame of n rows, narrowest first: (width, oldest rows outside its tiles)."""
    levels = []
    while n > NARROW:
        levels.append((n, n % TILES))
        n //= TILES
    return [(n, 0), *reversed(levels)]


def _tiled(df: DataFrame, widths: dict[str, int], base: Column, narrow, merge, by: str, order: str) -> DataFrame:
    """Add a column of each name with `base` over the last rows of that width.

    `narrow` is the aggregate of a narrow frame, `merge` folds values from the oldest to the
    newest. Levels of all widths that don't need each other are made side by side.
    """
    ladders = {name: _tiles(n) for name, n in widths.items()}
    at = lambda name, level: f"_{name}_{level}"
    rows = df.withColumn("_base", base)
    rows = rows.withColumns({at(name, 0): narrow("_base").over(_last(steps[0][0], by, order)) for name, steps in ladders.items()})
    for level in range(1, max(map(len, ladders.values()))):
        made = {}
        for name, steps in ladders.items():
            if level < len(steps):
                width, rest = steps[level]
                tile = steps[level - 1][0]
                single = [F.lag("_base", k).over(_w(by, order)) for k in range(width - 1, width - 1 - rest, -1)]
                made[at(name, level)] = merge([*single, *[F.lag(at(name, level - 1), k * tile).over(_w(by, order)) for k in range(TILES - 1, 0, -1)], F.col(at(name, level - 1))])
        rows = rows.withColumns(made)
    spent = [at(name, level) for name, steps in ladders.items() for level in range(len(steps))]
    return rows.withColumns({name: F.col(at(name, len(steps) - 1)) for name, steps in ladders.items()}).drop("_base", *spent)


def sliding_max(df: DataFrame, column: str, widths: dict[str, int], by: str = BY, order: str = ORDER) -> DataFrame:
    """Largest value of the last rows, a column for each name and width; null where all are null."""
    return _tiled(df, widths, F.col(column), F.max, lambda c: F.greatest(*c), by, order)


def _added(columns: list[Column]) -> Column:
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(c, F.lit(0.0))
    return total


def sliding_mean(df: DataFrame, column: str, widths: dict[str, int], by: str = BY, order: str = ORDER) -> DataFrame:
    """Mean of the last rows, a column for each name and width; null where all are null.

    Sums are tiled; the number of values is a difference of running counts, which are whole.
    """
    sums = {f"_sum_{name}": n for name, n in widths.items()}
    rows = _tiled(df, sums, F.coalesce(F.col(column).cast("double"), F.lit(0.0)), F.sum, _added, by, order)
    rows = rows.withColumn("_seen", F.count(column).over(_w(by, order).rowsBetween(W.unboundedPreceding, 0)))
    count = lambda n: F.col("_seen") - F.coalesce(F.lag("_seen", n).over(_w(by, order)), F.lit(0))
    rows = rows.withColumns({f"_count_{name}": count(n) for name, n in widths.items()})
    # no values give 0 of 0
    means = {name: F.try_divide(F.col(f"_sum_{name}"), F.col(f"_count_{name}")) for name in widths}
    return rows.withColumns(means).drop("_seen", *sums, *[f"_count_{name}" for name in widths])


def tiled_sum(values: Column, n: int) -> Column:
    """Sum of an array of n doubles without nulls, added in the order of `sliding_mean`'s tiles."""
    if n <= NARROW:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    rest, tile = n % TILES, n // TILES
    start = F.aggregate(F.slice(values, 1, rest), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(F.sequence(F.lit(0), F.lit(TILES - 1)), start, lambda a, k: a + tiled_sum(F.slice(values, k * tile + rest + 1, tile), tile))


def _return(k: int, close: str = "close") -> Column:
    return F.try_divide(F.col(close), F.lag(close, k).over(_w())) - 1


def returns_1d_5d_21d(df: DataFrame) -> DataFrame:
    return df.withColumns({f"returns_{k}d": _return(k) for k in (1, 5, 21)})


def momentum_12_1(df: DataFrame) -> DataFrame:
    """Close 21 rows back against 252 rows back."""
    return df.withColumn("momentum_12_1", F.try_divide(F.lag("close", 21).over(_w()), F.lag("close", 252).over(_w())) - 1)


def high_52w(df: DataFrame) -> DataFrame:
    return sliding_max(df, "close", {"high_52w": 252})


def pct_below_52w_high(df: DataFrame) -> DataFrame:
    rows = sliding_max(df, "close", {"_high": 252})
    return rows.withColumn("pct_below_52w_high", F.try_divide(F.col("_high") - F.col("close"), F.col("_high"))).drop("_high")


def sma(df: DataFrame, n: int) -> DataFrame:
    return sliding_mean(df, "close", {f"sma_{n}": n})


def sma_50(df: DataFrame) -> DataFrame:
    return sma(df, 50)


def sma_200(df: DataFrame) -> DataFrame:
    return sma(df, 200)


def dist_sma(df: DataFrame, n: int) -> DataFrame:
    """Distance from the average, in parts of it; needs or adds sma_n."""
    df = df if f"sma_{n}" in df.columns else sma(df, n)
    return df.withColumn(f"dist_sma_{n}", F.try_divide(F.col("close"), F.col(f"sma_{n}")) - 1)


def realized_vol_21d(df: DataFrame) -> DataFrame:
    """Yearly volatility of the last 21 daily returns; needs or adds returns_1d."""
    df = df if "returns_1d" in df.columns else df.withColumn("returns_1d", _return(1))
    return df.withColumn("realized_vol_21d", F.stddev_samp("returns_1d").over(_last(21)) * F.sqrt(F.lit(252.0)))


def rolling_vol_full_window(df: DataFrame, n: int = 21) -> DataFrame:
    """As realized volatility, but null unless all n returns are there."""
    df = df if "returns_1d" in df.columns else df.withColumn("returns_1d", _return(1))
    full = F.count("returns_1d").over(_last(n)) == n
    return df.withColumn("rolling_vol", F.when(full, F.stddev_samp("returns_1d").over(_last(n)) * F.sqrt(F.lit(252.0))))


def all_factors(df: DataFrame) -> DataFrame:
    """Every price factor, in one partitioning: the first level over closes, then those over its columns."""
    first = {f"returns_{k}d": _return(k) for k in (1, 5, 21)}
    first["momentum_12_1"] = F.try_divide(F.lag("close", 21).over(_w()), F.lag("close", 252).over(_w())) - 1
    rows = sliding_max(df.withColumns(first), "close", {"_high": 252})
    rows = sliding_mean(rows, "close", {"sma_50": 50, "sma_200": 200})
    rows = rows.withColumn("realized_vol_21d", F.stddev_samp("returns_1d").over(_last(21)) * F.sqrt(F.lit(252.0)))
    close = F.col("close")
    return rows.withColumns({
        "pct_below_52w_high": F.try_divide(F.col("_high") - close, F.col("_high")),
        "dist_sma_50": F.try_divide(close, F.col("sma_50")) - 1,
        "dist_sma_200": F.try_divide(close, F.col("sma_200")) - 1,
    }).drop("_high")


def rolling_views_30(df: DataFrame, by: str = BY, order: str = "activity_date", tie: str | None = None) -> DataFrame:
    """Mean views over 30 rows, and the day's views against it."""
    keys = [order] if tie is None else [order, tie]
    mean = F.avg("views").over(W.partitionBy(by).orderBy(*keys).rowsBetween(-29, 0))
    return df.withColumn("views_30d_avg", mean).withColumn("views_vs_30d_avg", F.try_divide(F.col("views"), F.col("views_30d_avg")))


def dedupe_latest_headline(news: DataFrame, tie: list[str]) -> DataFrame:
    """One row for each symbol and story: the newest ingested, then by `tie`; stories without any name are one per symbol."""
    keyed = news.withColumn("_key", dedupe_key("symbol", "uuid", "link", "title"))
    order = [F.col("ingested_ts").desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie]]
    return keyed.withColumn("_n", F.row_number().over(W.partitionBy("_key").orderBy(*order))).where("_n = 1").drop("_key", "_n")


def cumulative_return(df: DataFrame, by: str = BY, order: str = ORDER) -> DataFrame:
    """Running product of 1 + r, less 1, over the rows with a return."""
    rows = df.where(F.col("returns_1d").isNotNull())
    grown = F.product(1 + F.col("returns_1d")).over(_w(by, order).rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("cumulative_return", grown - 1)


def drawdown(df: DataFrame, by: str = BY, order: str = ORDER) -> DataFrame:
    """Close against the highest so far, in percent."""
    peak = F.max("close").over(_w(by, order).rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("drawdown", (F.try_divide(F.col("close"), peak) - 1) * 100)


def previous_close_delta(df: DataFrame, by: str = BY, order: str = ORDER) -> DataFrame:
    """Last row of each series with its change in percent against the close before, else the day's open."""
    before = F.coalesce(F.lag("close").over(_w(by, order)), F.col("open"))
    last = F.row_number().over(W.partitionBy(by).orderBy(F.desc(order)))
    return df.withColumns({"delta_pct": (F.try_divide(F.col("close"), before) - 1) * 100, "_n": last}).where("_n = 1").drop("_n")


def surrogate_ids(new: DataFrame, existing: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """Ids for new rows: the largest so far plus a dense sequence in `order`.

    Rows are ranged by `order`, numbered within their partition and written once, since a
    second range exchange would draw other bounds; the table's own counts then lift each
    partition by those before it, so no task holds all rows.
    """
    spark = new.sparkSession
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_top"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "numbered")
    number = F.monotonically_increasing_id()  # the partition from bit 33 on, the row in it below
    new.drop(id_col).repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", number).write.parquet(path)
    numbered = spark.read.parquet(path).withColumns({"_part": F.shiftright("_at", 33), "_n": F.col("_at") % F.lit(1 << 33) + 1}).drop("_at")
    sizes = numbered.groupBy("_part").agg(F.max("_n").alias("_size"))  # a row for each partition
    before = sizes.select("_part", F.coalesce(F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    joined = numbered.join(F.broadcast(before), "_part").join(F.broadcast(top))
    return joined.withColumn(id_col, (F.col("_top") + F.col("_before") + F.col("_n")).cast("long")).drop("_top", "_before", "_n", "_part")


def zscore(df: DataFrame, cols: list[str], by: str = ORDER) -> DataFrame:
    """Distance from the day's mean in population deviations; 0 where these are 0 or null."""
    w = W.partitionBy(by)
    out = {}
    for c in cols:
        spread = F.stddev_pop(c).over(w)
        out[f"z_{c}"] = F.when(F.coalesce(spread, F.lit(0.0)) == 0, 0.0).otherwise((F.col(c) - F.avg(c).over(w)) / spread)
    return df.withColumns(out)
