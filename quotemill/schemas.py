"""Explicit schemas of the market tables."""

from pyspark.sql import types as T

L, D, S, B, DT, TS = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType()


def _of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


BARS = _of(symbol=S, timestamp=TS, open=D, high=D, low=D, close=D, volume=L, trade_count=L, vwap=D, ingested_ts=TS)
SILVER_BARS = _of(asset_id=L, **{f.name: f.dataType for f in BARS.fields})
ASSETS = _of(
    asset_id=L, source_id=S, symbol=S, name=S, asset_class=S, exchange=S, source_status=S, tradable=B, marginable=B, shortable=B, easy_to_borrow=B, fractionable=B,
    min_order_size=S, min_trade_increment=S, price_increment=S, maintenance_margin_requirement=D, attributes=T.ArrayType(S), is_active=B, is_sp500=B, article_title=S, ingested_ts=TS,
)
ASSET_HISTORY = _of(asset_id=L, source_id=S, symbol=S, change_type=S, change_date=DT, change_ts=TS, previous_is_active=B, new_is_active=B)
CONSTITUENTS = _of(symbol=S, security=S, gics_sector=S, gics_sub_industry=S, headquarters_location=S, date_first_added=S, cik=S, founded=S, asset_id=L, ingested_ts=TS, source_url=S)
NEWS = _of(symbol=S, uuid=S, title=S, publisher=S, link=S, provider_publish_time=TS, type=S, summary=S, query_date=DT, ingested_ts=TS)
SILVER_NEWS = _of(asset_id=L, symbol=S, uuid=S, title=S, publisher_id=L, link=S, provider_publish_time=TS, type=S, summary=S, query_date=DT, ingested_ts=TS)
HEADLINES = T.StructType([*SILVER_NEWS.fields, T.StructField("sentiment", S)])
PUBLISHERS = _of(publisher_id=L, publisher_name=S, publisher_name_norm=S, ingested_ts=TS, publisher_domain=S, publisher_weight=D, weight_source=S, weight_updated_ts=TS)
RANKS = _of(rank=L, domain=S)
PAGEVIEWS = _of(symbol=S, company_name=S, article=S, project=S, access=S, agent=S, granularity=S, view_date=S, views=L, ingested_ts=TS)
SILVER_PAGEVIEWS = _of(asset_id=L, granularity=S, view_date=DT, views=L, ingested_ts=TS)
GOLD_PRICES = _of(
    asset_id=L, symbol=S, trade_date=DT, open=D, high=D, low=D, close=D, volume=L, trade_count=L, vwap=D, dollar_volume=D, returns_1d=D, returns_5d=D, returns_21d=D,
    realized_vol_21d=D, momentum_12_1=D, pct_below_52w_high=D, sma_50=D, sma_200=D, dist_sma_50=D, dist_sma_200=D, sentiment_score=D,
)
GOLD_ACTIVITY = _of(asset_id=L, activity_date=DT, source=S, event_type=S, views=L, views_30d_avg=D, views_vs_30d_avg=D, ingested_ts=TS)
RUN_LOG = _of(run_id=S, job_name=S, status=S, start_time=TS, end_time=TS, duration_seconds=D, partition_key=S, tags_json=S, assets_materialized_count=L, row_count=L, rows_inserted=L, rows_updated=L, rows_deleted=L, error_message=S, logged_ts=TS)
RUN_ASSET_LOG = _of(run_id=S, job_name=S, status=S, partition_key=S, asset_key=S, assets_materialized_count=L, row_count=L, rows_inserted=L, rows_updated=L, rows_deleted=L, logged_ts=TS)
CHECK_ROW = _of(check_id=S, run_id=S, job_name=S, partition_key=S, check_name=S, severity=S, status=S, measured_value=D, threshold_value=D, details_json=S, logged_ts=TS)
EVENTS = _of(run_id=S, job_name=S, asset_key=S, event_ts=TS, metadata_json=S)
