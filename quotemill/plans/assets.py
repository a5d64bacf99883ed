"""Reference data: assets with stable ids, status changes with history, index constituents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import add_column_if_missing, norm_symbol
from ..operators.filters import rename_known
from ..operators.joins import join_sp500_assets
from ..operators.merges import symbol_set_precedence
from ..operators.windows import surrogate_ids

#: Column names of a landed asset snapshot and of the constituents (fixed values).
SNAPSHOT_NAMES = {"id": "source_id", "class": "asset_class", "status": "source_status"}
CONSTITUENT_NAMES = {
    "Symbol": "symbol",
    "Security": "security",
    "GICS Sector": "gics_sector",
    "GICS Sub-Industry": "gics_sub_industry",
    "Headquarters Location": "headquarters_location",
    "Date first added": "date_first_added",
    "CIK": "cik",
    "Founded": "founded",
}


def assets_upsert(snapshot: DataFrame, existing: DataFrame | None, constituents: DataFrame | None, titles: DataFrame | None) -> DataFrame:
    """The snapshot with ids that stay: by source id, else (no source id) by symbol; new rows get the next ids in (symbol, source id) order.

    `is_active` is carried over (new rows: inactive), `is_sp500` is membership now, titles
    come from the bindings, else from before.
    """
    rows = rename_known(snapshot, SNAPSHOT_NAMES).drop("asset_id", "is_active", "is_sp500")
    rows = add_column_if_missing(rows, "source_id", "string")
    spark = snapshot.sparkSession
    old = existing if existing is not None else spark.createDataFrame([], schemas.ASSETS)
    old = add_column_if_missing(add_column_if_missing(old, "article_title", "string"), "source_id", "string")
    by_id = old.where("source_id IS NOT NULL").groupBy(F.col("source_id").alias("_source")).agg(F.min(F.struct("asset_id", "is_active", "article_title")).alias("_a"))
    by_symbol = old.groupBy(norm_symbol("symbol").alias("_symbol")).agg(F.min(F.struct("asset_id", "is_active", "article_title")).alias("_b"))
    joined = rows.join(by_id, F.col("source_id") == F.col("_source"), "left").join(by_symbol, F.col("source_id").isNull() & (norm_symbol("symbol") == F.col("_symbol")), "left")
    found = joined.withColumn("_old", F.coalesce("_a", "_b")).drop("_a", "_b", "_source", "_symbol")
    known = found.where("_old IS NOT NULL").withColumns({"asset_id": F.col("_old.asset_id"), "is_active": F.coalesce("_old.is_active", F.lit(False)), "_title": F.col("_old.article_title")})
    new = surrogate_ids(found.where("_old IS NULL"), old, "asset_id", ["symbol", "source_id"]).withColumns({"is_active": F.lit(False), "_title": F.lit(None).cast("string")})
    out = known.unionByName(new).drop("_old", "article_title")
    if constituents is None:
        out = out.withColumn("is_sp500", F.lit(False))
    else:
        members = constituents.select(norm_symbol("symbol").alias("_member")).distinct()
        out = out.join(members, norm_symbol("symbol") == F.col("_member"), "left").withColumn("is_sp500", F.col("_member").isNotNull()).drop("_member")
    if titles is None:
        return out.withColumnRenamed("_title", "article_title")
    named = titles.select(norm_symbol("symbol").alias("_named"), F.col("title").alias("_new_title"))
    out = out.join(named, norm_symbol("symbol") == F.col("_named"), "left")
    return out.withColumn("article_title", F.coalesce("_new_title", "_title")).drop("_named", "_new_title", "_title")


def asset_history_init(spark: SparkSession) -> DataFrame:
    """The empty history table."""
    return spark.createDataFrame([], schemas.ASSET_HISTORY)


def asset_status_updates(assets: DataFrame, activate: DataFrame, deactivate: DataFrame, now: datetime) -> tuple[DataFrame, DataFrame]:
    """(assets, history): apply both lists, deactivation first in rank; each changed row gives two history rows."""
    wanted = symbol_set_precedence(activate, deactivate).select(F.col("symbol").alias("_symbol"), F.col("is_active").alias("_wanted"))
    joined = assets.join(wanted, norm_symbol("symbol") == F.col("_symbol"), "left")
    changed = joined.where(F.col("_wanted").isNotNull() & ~F.col("_wanted").eqNullSafe(F.col("is_active")))
    updated = joined.withColumn("is_active", F.coalesce("_wanted", "is_active")).select(*assets.columns)
    stamp = F.lit(now).cast("timestamp")
    base = changed.select("asset_id", F.col("source_id") if "source_id" in assets.columns else F.lit(None).cast("string").alias("source_id"), "symbol", stamp.cast("date").alias("change_date"), stamp.alias("change_ts"), F.col("is_active").alias("_before"), F.col("_wanted").alias("new_is_active"))
    turned = base.withColumns({"change_type": F.when(F.col("new_is_active"), "activated").otherwise("deactivated"), "previous_is_active": F.col("_before")})
    shot = base.withColumns({"change_type": F.lit("snapshot"), "previous_is_active": F.lit(None).cast("boolean")})
    columns = [f.name for f in schemas.ASSET_HISTORY.fields]
    return updated, turned.select(*columns).unionByName(shot.select(*columns))


def unknown_symbols(assets: DataFrame, listed: DataFrame) -> DataFrame:
    """Listed symbols that no asset has."""
    return listed.select(norm_symbol("symbol").alias("symbol")).distinct().join(assets.select(norm_symbol("symbol").alias("symbol")), "symbol", "left_anti")


def sp500_reference(constituents: DataFrame, assets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(constituents, assets): normalized constituents with asset ids; members' flags set, none taken back."""
    rows = rename_known(constituents, CONSTITUENT_NAMES).withColumn("symbol", norm_symbol("symbol"))
    listed = join_sp500_assets(rows, assets)
    members = rows.select(F.col("symbol").alias("_member")).distinct()
    flagged = add_column_if_missing(assets, "is_sp500", "boolean", False).join(members, norm_symbol("symbol") == F.col("_member"), "left")
    return listed, flagged.withColumn("is_sp500", F.col("is_sp500") | F.col("_member").isNotNull()).drop("_member")
