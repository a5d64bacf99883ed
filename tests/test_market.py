"""The reference's fixtures and the edge cases of each area."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quotemill import schemas
from quotemill.functions import calendar as cal
from quotemill.functions import columns as C
from quotemill.operators import aggregations as A
from quotemill.operators import filters as P
from quotemill.operators import joins as J
from quotemill.operators import merges as M
from quotemill.operators import topk as K
from quotemill.operators import windows as V
from quotemill.plans import activity, news, prices, quality, runlog
from quotemill.plans import assets as AS
from quotemill.sources import readers as R
from quotemill.sources import sinks as S

DAY = date(2026, 2, 13)
NOW = datetime(2026, 2, 14)


def at(hour, minute, day=13):
    return datetime(2026, 2, day, hour, minute)


def bars(spark, symbols=("AAPL", "MSFT", "NVDA")):
    rows = []
    for s in symbols:
        rows += [(s, at(14, 35), 100.0, 101.0, 99.5, 100.8, 1000, 12, 100.6, NOW), (s, at(14, 40), 101.0, 102.0, 100.5, 101.6, 1200, 15, 101.4, NOW)]
    return spark.createDataFrame(rows, schemas.BARS)


def assets(spark, rows):
    return spark.createDataFrame(rows, "asset_id long, symbol string, name string, is_active boolean")


def column(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("x")).first().x


def run_day(spark, tmp_path, active):
    paths = prices.Paths(str(tmp_path))
    S.sink_replace_day(bars(spark), paths.table("bronze", "bars"))
    assets(spark, active).write.mode("overwrite").parquet(paths.table("silver", "assets"))
    prices.silver_prices(spark, paths, DAY)
    return paths


def test_end_to_end_day(spark, tmp_path):
    paths = run_day(spark, tmp_path, [(1, "AAPL", "a", True), (2, "MSFT", "b", True), (3, " nvda ", "c", True)])
    assert spark.read.parquet(paths.table("silver", "prices")).count() == 6
    assert prices.gold_prices_incremental(spark, paths, DAY) == (3, 0)
    row = spark.read.parquet(paths.table("gold", "prices")).where("asset_id = 1").first()
    assert (row.open, row.high, row.low, row.close, row.volume, row.trade_count) == (100.0, 102.0, 99.5, 101.6, 2200, 27)
    assert prices.gold_prices_incremental(spark, paths, DAY) == (3, 3)


def test_rerun_removes_a_symbol_that_is_gone(spark, tmp_path):
    run_day(spark, tmp_path, [(1, "AAPL", "a", True), (2, "MSFT", "b", True), (3, "NVDA", "c", True)])
    paths = run_day(spark, tmp_path, [(1, "AAPL", "a", True), (2, "MSFT", "b", True), (3, "NVDA", "c", False)])
    assert {r.symbol for r in R.scan_silver_day(spark, paths.table("silver", "prices"), DAY).collect()} == {"AAPL", "MSFT"}


def test_duplicate_active_symbol_takes_the_smallest_id(spark):
    rows = J.join_bars_assets(bars(spark, ["AAPL"]), assets(spark, [(99, "aapl", "x", True), (1, "AAPL ", "y", True)])).collect()
    assert [r.asset_id for r in rows] == [1, 1]


def test_vwap_return_and_sentiment(spark):
    day = [(1, "AAPL", at(14, 31), 100.0, 101.0, 99.0, 101.0, 10, 5, 100.0, NOW), (1, "AAPL", at(14, 35), 101.0, 102.0, 100.0, 101.5, 70, 20, None, NOW), (1, "AAPL", at(14, 40), 101.5, 103.0, 101.0, 102.0, 20, 8, 102.0, NOW)]
    stored = spark.createDataFrame([(1, "AAPL", date(2026, 2, 12), 100.0)], "asset_id long, symbol string, trade_date date, close double")
    headlines = spark.createDataFrame([(1, 1, "positive", at(15, 0, 12)), (1, 2, "negative", at(15, 0, 11)), (1, 1, "odd", at(15, 0, 12)), (1, 1, "negative", at(0, 0, 6)), (1, 1, "negative", at(0, 0, 14)), (1, 3, "negative", at(15, 0, 12))], "asset_id long, publisher_id long, sentiment string, provider_publish_time timestamp")
    publishers = spark.createDataFrame([(1, 2.0), (2, 1.0), (3, 0.0)], "publisher_id long, publisher_weight double")
    scores = A.weighted_sentiment_7d(headlines, publishers, DAY)
    row = prices.gold_day(spark.createDataFrame(day, schemas.SILVER_BARS), stored, DAY, None, scores).first()
    assert row.close == 102.0 and row.vwap == pytest.approx((100 * 10 + 102 * 20) / 30) and row.returns_1d == pytest.approx(0.02) and row.sentiment_score == pytest.approx(1 / 3)


def test_failed_build_keeps_the_stored_slice(spark, tmp_path):
    root = str(tmp_path / "gold")
    spark.createDataFrame([(1, DAY, 200.0)], "asset_id long, trade_date date, close double").write.partitionBy("trade_date").parquet(root)
    bad = spark.createDataFrame([(1, DAY, "x")], "asset_id long, trade_date date, c string").withColumn("close", F.raise_error(F.lit("broken")).cast("double")).drop("c")
    with pytest.raises(Exception, match="broken"):
        S.replace_date_slice(bad, root, DAY)
    assert spark.read.parquet(root).first().close == 200.0
    empty = spark.createDataFrame([], "asset_id long, trade_date date, close double")
    assert S.replace_date_slice(empty, root, DAY) == (0, 1)


def test_metric_rollup_and_aliases(spark):
    rows = [("r", "j", "silver/news", '{"row_count": 10, "rows_inserted": 6}'), ("r", "j", "silver/news", '{"row_count": 4, "inserted_count": 6}'), ("r", "j", "gold/headlines", '{"rows_updated": 2, "deleted_count": 1}')]
    events = spark.createDataFrame([(*r[:3], at(9, k), r[3]) for k, r in enumerate(rows)], schemas.EVENTS)
    got = {r.asset_key: (r.assets_materialized_count, r.row_count, r.rows_inserted, r.rows_updated, r.rows_deleted) for r in A.asset_metrics_rollup(events).collect()}
    assert got == {"gold/headlines": (1, None, 0, 2, 1), "silver/news": (2, 14, 12, 0, 0)}
    runs = spark.createDataFrame([("r", "j", "SUCCESS", None, None), ("q", "j", "FAILURE", NOW, None)], "run_id string, job_name string, status string, start_time timestamp, end_time timestamp")
    log, per_asset = runlog.pipeline_run_log(events, runs, NOW)
    by_run = {r.run_id: r for r in log.collect()}
    assert (by_run["r"].row_count, by_run["r"].rows_inserted, by_run["r"].duration_seconds, by_run["r"].assets_materialized_count) == (14, 12, 120.0, 3)
    assert by_run["q"].assets_materialized_count == 0 and by_run["q"].rows_inserted is None and per_asset.count() == 2


@pytest.mark.parametrize("json, value", [('{"n": 3}', 3), ('{"n": {"value": 7}}', 7), ('{"n": 5.0}', 5), ('{"n": 5.5}', None), ('{"n": true}', None), ('{"m": 4}', 4), ('{"n": 1, "m": 2}', 1), ('{"n": "x", "m": 2}', 2), (None, None)])
def test_metadata_int(spark, json, value):
    assert column(spark, json, lambda c: C.metadata_int(c, "n", "m")) == value


def test_calendar(spark):
    days = spark.createDataFrame([(date(2026, 2, d),) for d in (18, 17, 16, 15, 14)], "date date")
    got = {r.date.day: r.previous_trading_day.day for r in cal.previous_trading_day(days).collect()}
    assert got == {18: 17, 17: 16, 16: 13, 15: 13, 14: 13}
    holidays = spark.createDataFrame([(date(2026, 2, 16),)], "date date")
    assert {r.date.day: r.previous_trading_day.day for r in cal.previous_trading_day(days, holidays).collect()}[17] == 13
    assert not column(spark, "2026-02-14", cal.is_weekday) and not column(spark, "not-a-date", cal.is_weekday) and column(spark, "2026-02-13", cal.is_weekday)
    assert column(spark, date(2026, 2, 17), cal.month_start, "date") == date(2026, 2, 1)
    assert cal.window_bounds(DAY, 30) == (date(2026, 1, 15), date(2026, 2, 14))


@pytest.mark.parametrize("host, base", [("www.bbc.co.uk", "bbc.co.uk"), ("finance.yahoo.com", "yahoo.com"), ("ft.com", "ft.com"), ("co.uk", "co.uk"), ("  A..B.com ", "b.com"), ("", ""), (None, "")])
def test_base_domain(spark, host, base):
    assert column(spark, host, C.base_domain) == base


@pytest.mark.parametrize("rank, weight", [(1, 1.0), (1000, 0.5), (1_000_000, 0.05), (None, 0.05), (0, 0.05)])
def test_rank_to_weight(spark, rank, weight):
    assert column(spark, rank, lambda c: C.rank_to_weight(c)[0], "long") == pytest.approx(weight)


def test_text_columns(spark):
    assert column(spark, "Alphabet Inc. Class A Common Stock", C.article_from_name) == "Alphabet_Inc."
    assert column(spark, "Marsh", C.article_from_name) == "Marsh_(company)"
    assert column(spark, " Lowe%27s a+b ", C.article_title) == "Lowe's_a+b" and column(spark, "50%", C.article_title) == "50%"
    assert [column(spark, v, lambda c: C.parse_view_date(c, DAY)) for v in ("2026021300", "2026-02-12", "junk", None)] == [DAY, date(2026, 2, 12), DAY, DAY]
    assert column(spark, "AA", lambda c: C.dedupe_key(c, F.lit(None).cast("string"), F.lit(" "), F.lit("T"))) == "AA::T"
    assert column(spark, " ", lambda c: C.symbol_label(F.lit("A"), c)) == "A"


def test_ohlc_skips_null_ends(spark):
    rows = [(1, "A", at(9, k), o, 5.0, 1.0, c, 1, 1, None, NOW) for k, (o, c) in enumerate([(None, 2.0), (2.0, 3.0), (3.0, 4.0), (4.0, None)])]
    row = A.daily_ohlc(spark.createDataFrame(rows, schemas.SILVER_BARS)).first()
    assert (row.open, row.close, row.vwap) == (2.0, 4.0, None)


def series(spark, closes, asset=1):
    return spark.createDataFrame([(asset, f"S{asset}", date(2024, 1, 1).fromordinal(date(2024, 1, 1).toordinal() + k), float(c), 10, float(c)) for k, c in enumerate(closes)], "asset_id long, symbol string, trade_date date, close double, volume long, open double")


def test_factors(spark):
    closes = [100 + (k * 7) % 13 for k in range(300)]
    rows = V.all_factors(series(spark, closes)).orderBy("trade_date").collect()
    assert rows[0].returns_1d is None and rows[0].sma_50 == 100 and rows[5].returns_5d == pytest.approx(closes[5] / closes[0] - 1)
    assert rows[299].momentum_12_1 == pytest.approx(closes[278] / closes[47] - 1) and rows[299].sma_200 == pytest.approx(sum(closes[100:]) / 200)
    assert rows[299].pct_below_52w_high == pytest.approx((max(closes[48:]) - closes[299]) / max(closes[48:]))
    returns = [closes[k] / closes[k - 1] - 1 for k in range(279, 300)]
    mean = sum(returns) / 21
    assert rows[299].realized_vol_21d == pytest.approx(math.sqrt(sum((r - mean) ** 2 for r in returns) / 20) * math.sqrt(252))
    zero = V.returns_1d_5d_21d(series(spark, [0, 1])).orderBy("trade_date").collect()
    assert [r.returns_1d for r in zero] == [None, None]
    single = V.all_factors(series(spark, [5])).first()
    assert single.realized_vol_21d is None and single.sma_200 == 5
    plan = V.all_factors(series(spark, closes))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_incremental_equals_backfill(spark):
    daily = series(spark, [100 + (k * 7) % 13 for k in range(300)]).withColumns({"high": F.col("close"), "low": F.col("close"), "timestamp": F.col("trade_date").cast("timestamp"), "trade_count": F.lit(1).cast("long"), "vwap": F.col("close")})
    full = prices.gold_prices_backfill(daily)
    day = daily.agg(F.max("trade_date")).first()[0]
    one = prices.gold_day(daily.where(F.col("trade_date") == F.lit(day)), full.where(F.col("trade_date") < F.lit(day)), day).first()
    assert one == full.where(F.col("trade_date") == F.lit(day)).first()


def test_dedupe_headlines(spark):
    rows = [("a", "u", "l", "t", 1), ("A", "u", "x", "y", 2), ("a", " ", "l", "t", 1), ("a", None, "l", "z", 3), ("a", None, None, "t", 1), ("a", None, None, None, 1), ("a", "", " ", "", 2), ("b", "u", "l", "t", 1)]
    df = spark.createDataFrame([(*r[:4], at(9, r[4])) for r in rows], "symbol string, uuid string, link string, title string, ingested_ts timestamp")
    assert V.dedupe_latest_headline(df, ["title"]).count() == 5


def test_pageviews(spark):
    raw = spark.createDataFrame([("x", "Firm One ", "20260213", "daily", 5, NOW), ("aa", None, "junk", "daily", 7, NOW), ("none", "nobody", "2026-02-13", "daily", 9, NOW), (None, None, None, "daily", 1, NOW)], "symbol string, company_name string, view_date string, granularity string, views long, ingested_ts timestamp")
    rows = activity.silver_pageview_rows(raw, assets(spark, [(1, "AA", "Other", True), (2, "BB", "firm one", True)]), DAY)
    assert {r.views: r.asset_id for r in rows.collect()} == {5: 2, 7: 1, 9: None, 1: None}
    assert M.merge_keep_last(rows.limit(0), rows, activity.KEYS, "ingested_ts").count() == 3
    gaps = spark.createDataFrame([(1, date(2026, 1, k), 10 * k) for k in range(1, 32) if k != 9], "asset_id long, activity_date date, views long")
    last = V.rolling_views_30(gaps).orderBy(F.desc("activity_date")).first()
    assert last.views_30d_avg == pytest.approx(sum(10 * k for k in range(1, 32) if k != 9) / 30)


def test_status_updates(spark):
    base = assets(spark, [(1, "A", "a", False), (2, "B", "b", True), (3, "C", "c", True), (4, "D", "d", None)])
    on = spark.createDataFrame([("a",), ("b",), (" C ",), ("d",), ("zz",)], "symbol string")
    off = spark.createDataFrame([("c",)], "symbol string")
    updated, history = AS.asset_status_updates(base, on, off, NOW)
    assert {r.asset_id: r.is_active for r in updated.collect()} == {1: True, 2: True, 3: False, 4: True}
    assert sorted((r.asset_id, r.change_type) for r in history.collect()) == [(1, "activated"), (1, "snapshot"), (3, "deactivated"), (3, "snapshot"), (4, "activated"), (4, "snapshot")]
    assert [r.symbol for r in AS.unknown_symbols(base, on).collect()] == ["ZZ"]


def test_surrogate_ids_stay_dense_at_scale(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        n = 1_200_000
        new = spark.range(n).select(F.concat(F.lit("k"), F.xxhash64("id")).alias("symbol"), F.col("id").alias("source_id"))
        existing = spark.createDataFrame([(7,)], "asset_id long")
        ids = V.surrogate_ids(new, existing, "asset_id", ["symbol", "source_id"])
        got = ids.agg(F.countDistinct("asset_id").alias("n"), F.min("asset_id").alias("lo"), F.max("asset_id").alias("hi")).first()
        assert (got.n, got.lo, got.hi) == (n, 8, n + 7)
        firsts = ids.orderBy("asset_id").limit(50).select("symbol", "source_id").collect()
        assert firsts == new.orderBy("symbol", "source_id").limit(50).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_assets_keep_their_ids(spark):
    old = spark.createDataFrame([(7, "x1", "AA", True, "T")], "asset_id long, source_id string, symbol string, is_active boolean, article_title string")
    snapshot = spark.createDataFrame([("x1", "AA2"), ("x3", "CC"), ("x2", "BB")], "id string, symbol string")
    members = spark.createDataFrame([("cc",)], "symbol string")
    titles = spark.createDataFrame([("bb", "New")], "symbol string, title string")
    rows = {r.source_id: r for r in AS.assets_upsert(snapshot, old, members, titles).collect()}
    assert {k: r.asset_id for k, r in rows.items()} == {"x1": 7, "x2": 8, "x3": 9}
    assert rows["x1"].is_active and rows["x1"].article_title == "T" and rows["x2"].article_title == "New" and rows["x3"].is_sp500 and not rows["x2"].is_sp500
    assert sorted(r.asset_id for r in AS.assets_upsert(snapshot, None, None, None).collect()) == [1, 2, 3]


def test_publishers(spark):
    existing = spark.createDataFrame([(4, "Old", "old", None, "old.com", 0.9, "tranco", NOW), (2, "Stale", "stale", None, None, 0.3, "default", datetime(2025, 1, 1))], schemas.PUBLISHERS)
    fresh = spark.createDataFrame([("Reuters", "x.com"), (" site.co.uk ", None), ("old", "other.com"), ("stale", "s.org"), ("stale", "s.org"), ("stale", "a.org"), (" ", None)], "publisher string, domain string")
    ranks = spark.createDataFrame([(100, "www.x.com"), (10, "x.com"), (1000, "s.org")], schemas.RANKS)
    rows = {r.publisher_name_norm: r for r in news.publishers_upsert(fresh, existing, ranks, news.overrides_table(spark), NOW).collect()}
    assert rows["old"].publisher_weight == 0.9 and rows["stale"].publisher_domain == "s.org" and rows["stale"].publisher_weight == pytest.approx(0.5)
    assert rows["reuters"].publisher_domain == "x.com" and rows["reuters"].publisher_weight == pytest.approx(1 - 2 / 6)
    assert rows["site.co.uk"].publisher_domain == "site.co.uk" and rows["site.co.uk"].weight_source == "default"
    assert {rows["reuters"].publisher_id, rows["site.co.uk"].publisher_id} == {5, 6}


def test_sentiment_paths(spark):
    df = spark.createDataFrame([("Profit and growth", None), (" ", "Losses fall"), (None, None)], "title string, summary string")
    assert [r.sentiment for r in news.score_sentiment(df).collect()] == ["positive", "negative", "neutral"]
    assert [r.sentiment for r in news.score_sentiment(df, lambda: lambda texts: [t[:4].upper() or "NONE" for t in texts], 2).collect()] == ["prof", "loss", "none"]


def test_merge_and_update(spark):
    old = spark.createDataFrame([(1, None, "a"), (2, "k", "b"), (3, "k", "c")], "id long, k string, v string")
    new = spark.createDataFrame([(1, None, "a"), (2, "k", "B"), (4, "k", "d")], "id long, k string, v string")
    assert J.merge_diff(old, new, ["id", "k"]).first() == Row(inserted=1, updated=1, deleted=1)
    assert sorted(r.v for r in M.update_from(old, new, ["id"], ["v"]).collect()) == ["B", "a", "c"]
    assert {r.id: r.v for r in M.update_correlated(old, new, ["id"], "v").collect()} == {1: "a", 2: "B", 3: None}
    assert M.sink_counts(old, new).first() == Row(rows_inserted=0, rows_deleted=0)
    views = spark.createDataFrame([(1, DAY)], "id long, d date")
    assert M.refresh_window(views, views, "d", DAY, DAY).count() == 2


def test_views(spark):
    day = spark.createDataFrame([(k, f"S{k}", DAY, (-1) ** k * k / 100, k / 50, float(k), 1.0) for k in range(1, 13)], "asset_id long, symbol string, trade_date date, returns_1d double, returns_21d double, dollar_volume double, realized_vol_21d double")
    assert [r.symbol for r in K.top_gainers_losers(day, 2).collect()] == ["S12", "S10", "S11", "S9"]
    assert A.concentration_impact(day.limit(0), {"S1"}).first().impact_share is None
    constant = V.zscore(day, ["realized_vol_21d"]).select("z_realized_vol_21d").distinct().collect()
    assert [r[0] for r in constant] == [0.0]
    assert P.horizon_filter(day, "1M").count() == 12 and P.latest_slice(day).count() == 12


def test_checks(spark):
    run = quality.RunInfo("r", "j", "2026-02-13", NOW)
    silver = J.join_bars_assets(bars(spark), assets(spark, [(1, "AAPL", "a", True), (2, "MSFT", "b", True), (3, "NVDA", "c", True)]))
    tables = {"spark": spark, "silver_prices": silver, "assets": assets(spark, [(1, "AAPL", "a", True), (2, "aapl", "b", True), (3, "ZZ", "c", True)]), "prices": silver}
    said = lambda name, t=tables, r=run: quality.check(name)(t, r, {}).first()
    assert said("dq_silver_prices_ranges").status == "PASS" and said("dq_silver_prices_uniqueness_asset_id_timestamp").status == "PASS"
    bad = silver.withColumn("low", F.lit(1000.0))
    assert said("dq_silver_prices_ranges", tables | {"silver_prices": bad}).measured_value == 6
    assert said("dq_silver_prices_ranges", tables | {"silver_prices": silver.drop("vwap")}).status == "SKIPPED"
    assert said("dq_silver_prices_schema_required_columns", tables | {"silver_prices": silver.drop("open", "close")}).measured_value == 2
    assert said("dq_silver_prices_partition_exists", tables | {"silver_prices": silver.limit(0)}).status == "FAIL"
    assert said("dq_silver_prices_null_thresholds", tables | {"silver_prices": silver.limit(0)}).measured_value == 0
    assert said("dq_silver_assets_active_symbol_uniqueness").measured_value == 1
    assert said("prices_active_symbol_coverage").status == "FAIL" and '"ZZ"' in said("prices_active_symbol_coverage").details_json
    assert said("prices_active_symbol_coverage", tables, quality.RunInfo("r", "j", "2026-02-14", NOW)).status == "SKIPPED"
    closed = tables | {"holidays": spark.createDataFrame([(DAY,)], "date date")}
    assert said("prices_active_symbol_coverage", closed, quality.RunInfo("r", "j", "2026-02-13", NOW)).status == "SKIPPED"
    assert said("prices_active_symbol_coverage", tables, quality.RunInfo("r", "j", "no day", NOW)).status == "SKIPPED"
    assert said("dq_daily_news_missing_partition", tables, quality.RunInfo("r", "j", None, NOW)).status == "SKIPPED"
    rows = {r.check_name: r for r in quality.check_isolation(["dq_gold_prices_ranges", "dq_silver_prices_ranges", "dq_gold_prices_table_exists"], tables, run).collect()}
    assert [rows[k].status for k in sorted(rows)] == ["FAIL", "FAIL", "PASS"] and "KeyError" in rows["dq_gold_prices_ranges"].details_json
    assert rows["dq_silver_prices_ranges"].severity == "RED"


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "merge")
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k long, v string, s long")
    S.sink_merge_keep_last(rows, path, ["k"], "s")
    assert S.sink_merge_keep_last(rows.where("s = 1"), path, ["k"], "s").collect() == [Row(k=1, v="a", s=1)]
    S.sink_bronze_symbol_day(bars(spark).withColumn("date", F.lit(DAY)), str(tmp_path / "bronze"))
    S.sink_bronze_symbol_day(bars(spark, ["AAPL"]).withColumn("date", F.lit(DAY)), str(tmp_path / "bronze"))
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 6
    odd = bars(spark, ["TRUE", "1E5"])
    S.sink_compact_month(odd, str(tmp_path / "compact"))
    assert {r.symbol for r in R.view_prices_compact(spark, str(tmp_path / "compact")).collect()} == {"TRUE", "1E5"}


def test_tiled_frames_equal_sliding_ones(spark):
    """Widths below, at and across the tiles' borders, with nulls, repeated values and series shorter than the frame."""
    import random

    from pyspark.sql import Window as W

    rng = random.Random(4)
    start = date(2020, 1, 1).toordinal()
    rows = [(a, date.fromordinal(start + k), None if rng.random() < 0.1 else rng.choice([-2.5, 0.1, 7.25, rng.uniform(-9, 9)])) for a, n in ((1, 330), (2, 40), (3, 1)) for k in range(n)]
    df = spark.createDataFrame([*rows, (4, date(2020, 1, 1), None)], "asset_id long, trade_date date, close double")
    widths = [1, 2, 8, 9, 12, 48, 50, 53, 200, 252]
    out = V.sliding_max(df, "close", {f"high_{n}": n for n in widths})
    out = V.sliding_mean(out, "close", {f"mean_{n}": n for n in widths})
    frame = lambda n: W.partitionBy("asset_id").orderBy("trade_date").rowsBetween(1 - n, 0)
    out = out.withColumns({f"max_{n}": F.max("close").over(frame(n)) for n in widths} | {f"avg_{n}": F.avg("close").over(frame(n)) for n in widths})
    for r in out.collect():
        for n in widths:
            assert r[f"high_{n}"] == r[f"max_{n}"]
            assert (r[f"mean_{n}"] is None) == (r[f"avg_{n}"] is None) and (r[f"avg_{n}"] is None or r[f"mean_{n}"] == pytest.approx(r[f"avg_{n}"], abs=1e-12))
    plan = V.high_52w(df)._jdf.queryExecution().executedPlan().toString()
    assert "-251" not in plan and plan.count("Sort [") == 1


def test_tiled_mean_depends_on_its_rows_alone(spark):
    """The last bit of a mean doesn't change with the rows before its frame, and an array gives the same."""
    closes = [0.1 * k * (-1) ** k + 1e9 * (k < 40) for k in range(300)]
    long = V.sma(series(spark, closes), 200).orderBy(F.desc("trade_date")).first().sma_200
    short = V.sma(series(spark, closes[100:]), 200).orderBy(F.desc("trade_date")).first().sma_200
    held = spark.range(1).select((V.tiled_sum(F.lit(closes[100:]), 200) / 200).alias("x")).first().x
    assert long == short == held


def test_raw_overrides(spark, tmp_path):
    raw = [("Reuters ", "https.www.reuters.com", 1), (" REUTERS", "news.Reuters.co.uk", 2), ("reuters", " ", 3), ("", "x.com", 4), (None, "y.com", 5), ("Quartz", None, 6), ("Paper", "www.paper.org", 7)]
    df = spark.createDataFrame(raw, "publisher_name string, publisher_domain string, seq long")
    known = {r.publisher_name_norm: r.override_domain for r in news.overrides_table(spark).collect()}
    want = known | {"reuters": "reuters.co.uk", "paper": "paper.org"}
    assert {r.publisher_name_norm: r.override_domain for r in news.overrides_table(spark, df, "seq").collect()} == want
    assert {r.publisher_name_norm: r.override_domain for r in news.overrides_table(spark, df.drop("publisher_domain")).collect()} == known
    path = tmp_path / "names.csv"
    path.write_text('publisher_name,publisher_domain\n' + "".join(f'"{a or ""}","{b or ""}"\n' for a, b, _ in raw))
    assert {r.publisher_name_norm: r.override_domain for r in news.load_overrides(spark, str(path)).collect()} == want
    for absent in (None, str(tmp_path / "none.csv")):
        assert {r.publisher_name_norm: r.override_domain for r in news.load_overrides(spark, absent).collect()} == known
    existing = spark.createDataFrame([], schemas.PUBLISHERS)
    fresh = spark.createDataFrame([("REUTERS",)], "publisher string")
    ranks = spark.createDataFrame([(100, "reuters.co.uk")], schemas.RANKS)
    row = news.publishers_upsert(fresh, existing, ranks, news.load_overrides(spark, str(path)), NOW).first()
    assert row.publisher_domain == "reuters.co.uk" and row.publisher_weight == pytest.approx(1 - 2 / 6)


def test_day_factors_equal_those_of_all_days(spark):
    from quotemill.plans import state

    rows = series(spark, [100 + (k * 7) % 13 for k in range(300)]).unionByName(series(spark, [5, 6, 7], 2)).withColumns({c: F.col("close") for c in ("high", "low")})
    for as_of in (date.fromordinal(date(2024, 1, 1).toordinal() + k) for k in (299, 2, 0, 400)):
        every = prices.price_factors(rows).where(F.col("trade_date") == F.lit(as_of))
        one = state.day_factors(rows, as_of).select(*every.columns)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, every.collect()))


def test_symbols_are_rows_not_folders(spark, tmp_path):
    """The number of folders and files follows the days, not the symbols; a second write replaces its symbols, null among them, in its days alone."""
    from datetime import datetime
    from pathlib import Path

    def made(symbols, days, close, **more):
        rows = [(s, datetime(2024, m, d, 10), close) for s in symbols for m, d in days]
        return spark.createDataFrame(rows, "symbol string, timestamp timestamp, close double").withColumns({k: F.lit(v) for k, v in more.items()})

    names = [None, "", "TRUE", *[f"S{k}" for k in range(200)]]
    days = [(1, 2), (1, 3), (2, 1)]
    first, second = made(names, days, 1.0), made([None, "S7"], days[:2], 2.0, note="late")
    compact, bronze = str(tmp_path / "compact"), str(tmp_path / "bronze")
    for rows in (first, second):
        S.sink_compact_month(rows, compact)
        S.sink_bronze_symbol_day(rows.withColumn("date", F.col("timestamp").cast("date")), bronze)
    want = sorted((str(s), m, d, 2.0 if s in (None, "S7") and m == 1 else 1.0, "late" if s in (None, "S7") and m == 1 else None) for s in names for m, d in days)
    for got, root in ((R.view_prices_compact(spark, compact), compact), (spark.read.option("mergeSchema", "true").parquet(bronze), bronze)):
        assert sorted((str(r.symbol), r.timestamp.month, r.timestamp.day, r.close, r.note) for r in got.collect()) == want
        assert len(list(Path(root).rglob("*.parquet"))) < 30
    assert {p.name for p in Path(compact).glob("*/*")} == {"month=01", "month=02"}
