"""Set operations, keep-last merges and table mutation as new DataFrames."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import norm_symbol


def union_history_today(history: DataFrame, today: DataFrame, as_of: date, lookback_days: int = 400, day: str = "trade_date") -> DataFrame:
    """Stored rows of [as_of - lookback, as_of) and today's."""
    kept = history.where((F.col(day) >= F.lit(as_of - timedelta(days=lookback_days))) & (F.col(day) < F.lit(as_of)))
    return kept.unionByName(today, allowMissingColumns=True)


def merge_keep_last(existing: DataFrame | None, new: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Both tables with the last row of each key: new before old, then the larger `seq`. Null keys are equal. A first write isn't deduplicated."""
    if existing is None:
        return new
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    last = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("_new"), F.col(seq).desc_nulls_last()))
    return both.withColumn("_n", last).where("_n = 1").drop("_n", "_new")


def union_jobs(known: list[str], runs: DataFrame) -> DataFrame:
    """Known and observed job names, sorted."""
    listed = runs.sparkSession.createDataFrame([(k,) for k in known], "job_name string")
    return runs.select("job_name").where(F.trim("job_name") != "").union(listed).distinct().orderBy("job_name")


def symbol_set_precedence(activate: DataFrame, deactivate: DataFrame) -> DataFrame:
    """(symbol, desired flag); deactivation wins."""
    off = deactivate.select(norm_symbol("symbol").alias("symbol")).where("symbol <> ''").distinct()
    on = activate.select(norm_symbol("symbol").alias("symbol")).where("symbol <> ''").distinct().join(off, "symbol", "left_anti")
    return on.withColumn("is_active", F.lit(True)).unionByName(off.withColumn("is_active", F.lit(False)))


def purge_before(df: DataFrame, ts: str, cutoff: date) -> DataFrame:
    """Rows not older than the cutoff; later ones stay."""
    return df.where(F.col(ts) >= F.lit(cutoff))


def refresh_window(existing: DataFrame, new: DataFrame, ts: str, start: date, end: date) -> DataFrame:
    """Existing rows outside [start, end), and the new ones."""
    inside = (F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end))
    return existing.where(~F.coalesce(inside, F.lit(False))).unionByName(new, allowMissingColumns=True)


def update_from(target: DataFrame, source: DataFrame, on: list[str], cols: list[str], where: Column | None = None) -> DataFrame:
    """Set `cols` of the rows with a match in `source` (one row per key, the least of several); `where` is on the target."""
    values = source.groupBy(*[F.col(k).alias(f"_k_{k}") for k in on]).agg(F.min(F.struct(*cols)).alias("_new"))
    match = F.lit(True) if where is None else where
    for k in on:
        match = match & (F.col(k) == F.col(f"_k_{k}"))
    joined = target.join(values, match, "left")
    hit = F.col("_new").isNotNull()
    return joined.withColumns({c: F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in cols}).select(*target.columns)


def update_correlated(target: DataFrame, source: DataFrame, on: list[str], col: str) -> DataFrame:
    """Overwrite a column by a lookup; rows without a match get null."""
    values = source.groupBy(*on).agg(F.min(col).alias("_new"))
    return target.join(values, on, "left").withColumn(col, F.col("_new")).select(*target.columns)


def replace_run_rows(existing: DataFrame, new: DataFrame, run_id: str = "run_id") -> DataFrame:
    """Rows of other runs, and the new ones."""
    return existing.join(new.select(run_id).distinct(), run_id, "left_anti").unionByName(new, allowMissingColumns=True)


def dedupe_run_check(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of other (run, check) pairs, and the new ones."""
    return existing.join(new.select("run_id", "check_name").distinct(), ["run_id", "check_name"], "left_anti").select(*existing.columns).unionByName(new, allowMissingColumns=True)


def sink_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: rows_inserted and rows_deleted from the tables' sizes."""
    sizes = old.agg(F.count("*").alias("_old")).join(F.broadcast(new.agg(F.count("*").alias("_new"))))
    more = F.col("_new") - F.col("_old")
    return sizes.select(F.greatest(more, F.lit(0)).alias("rows_inserted"), F.greatest(-more, F.lit(0)).alias("rows_deleted"))
