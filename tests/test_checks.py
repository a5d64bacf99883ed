"""Checks fused by table: scans, counts, and checks that raise."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotemill.operators import aggregations as A
from quotemill.plans import quality

RUN = quality.RunInfo("r", "j", "2024-01-15", datetime(2024, 1, 16))
PRICES = "asset_id long, symbol string, timestamp timestamp, open double, high double, low double, close double, volume long, trade_count long, vwap double, ingested_ts timestamp"


def prices(spark, n=300, seed=1):
    rng = random.Random(seed)
    some = lambda v, p=0.1: None if rng.random() < p else v
    rows = []
    for _ in range(n):
        at = datetime(2024, 1, 15, 14) + timedelta(minutes=5 * rng.randrange(40))
        o, h, lo, c = (rng.uniform(-1, 100) for _ in range(4))
        rows.append((some(rng.randrange(8)), some(rng.choice(["A", " ", "b"])), some(at), some(o), some(max(h, 50.0)), some(lo), some(c), some(rng.randrange(9)), some(1), some(c), at))
    return spark.createDataFrame(rows, PRICES)


def tables(spark, path):
    assets = spark.createDataFrame([(1, "A", True), (1, "a ", True), (2, None, None), (3, "C", False), (None, "", True)], "asset_id long, symbol string, is_active boolean")
    views = spark.createDataFrame([(1, date(2024, 1, 15), "daily", 5), (1, date(2024, 1, 15), "daily", -1), (None, None, None, None), (2, date(2024, 1, 15), "daily", None)], "asset_id long, view_date date, granularity string, views long").withColumn("ingested_ts", F.lit(None).cast("timestamp"))
    ranks = spark.createDataFrame([(1, "a.com"), (1, "A.com "), (2, None), (2_000_000, "b.com")], "rank long, domain string")
    made = {"silver_prices": prices(spark), "assets": assets, "silver_pageviews": views, "ranks": ranks}
    for name, df in made.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        made[name] = spark.read.parquet(f"{path}/{name}")
    return made | {"spark": spark, "prices": made["silver_prices"]}


def names(*starts):
    return [n for n, c in quality.CHECKS.items() if isinstance(c, quality.Check) and c.table in starts]


def test_one_scan_for_each_table(spark, tmp_path):
    given = tables(spark, str(tmp_path))
    checks = names("silver_prices", "assets", "silver_pageviews", "ranks")
    frame = quality.suite(checks, given, RUN)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 4 and len(checks) > 20
    assert sorted(r.check_name for r in frame.collect()) == sorted(checks)


def test_fused_rows_equal_the_operators(spark, tmp_path, monkeypatch):
    given = tables(spark, str(tmp_path))
    checks = names("silver_prices", "assets", "silver_pageviews", "ranks")
    rows = {r.check_name: r for r in quality.check_isolation(checks, given, RUN).collect()}
    df = given["silver_prices"]
    measured = lambda n: rows[n].measured_value
    assert measured("dq_silver_prices_uniqueness_asset_id_timestamp") == A.excess_duplicates(df, ["asset_id", "timestamp"]).first()[0] > 0
    assert measured("dq_silver_prices_ranges") == A.range_violations(df, quality.price_rules()).first()[0] > 0
    profile = A.null_profile(df, quality.REQUIRED["silver_prices"][:8], ("symbol",)).first()
    assert measured("dq_silver_prices_null_thresholds") == profile.max_share and f'"null_symbol":{profile.null_symbol}' in rows["dq_silver_prices_null_thresholds"].details_json
    assert measured("wikipedia_assets_with_views_min_count") == A.count_distinct_assets(given["silver_pageviews"]).first()[0] == 1
    assert measured("dq_silver_wikipedia_uniqueness_asset_id_view_date_granularity") == 1  # the null key is there once
    assert measured("dq_silver_assets_uniqueness_asset_id_and_symbol") == 2 and measured("dq_silver_assets_active_symbol_uniqueness") == 1
    assert measured("dq_bronze_tranco_uniqueness_rank_and_domain") == 2 and measured("dq_bronze_tranco_ranges") == 2
    assert measured("dq_silver_wikipedia_range_views_non_negative") == 1
    alone = {n: quality.CHECKS[n](given, RUN, {}).first() for n in checks}
    assert alone == rows
    monkeypatch.setattr(quality, "BITS", 4)  # flags in several numbers
    assert {r.check_name: r for r in quality.check_isolation(checks, given, RUN).collect()} == rows


def test_a_check_that_raises_fails_alone(spark, tmp_path):
    given = tables(spark, str(tmp_path))
    checks = names("silver_prices", "assets")
    lacking = given | {"silver_prices": given["silver_prices"].drop("high")}  # can't be planned
    rows = {r.check_name: r for r in quality.check_isolation(checks, lacking, RUN).collect()}
    whole = {r.check_name: r for r in quality.check_isolation(checks, given, RUN).collect()}
    bad = {"dq_silver_prices_null_thresholds", "dq_silver_prices_ranges"}
    assert {n for n in checks if rows[n].status == "FAIL" and rows[n].measured_value is None} == bad
    assert rows["dq_silver_prices_schema_required_columns"].measured_value == 1
    assert all(rows[n] == whole[n] for n in checks if n not in bad and "schema" not in n)
    broken = given | {"assets": given["assets"].withColumn("is_active", F.when(F.col("asset_id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("is_active")).cast("boolean"))}  # breaks while it runs
    rows = {r.check_name: r for r in quality.check_isolation(checks, broken, RUN).collect()}
    assert "broken" in rows["dq_silver_assets_active_symbol_uniqueness"].details_json
    assert rows["dq_silver_assets_uniqueness_asset_id_and_symbol"] == whole["dq_silver_assets_uniqueness_asset_id_and_symbol"]
    assert all(rows[n] == whole[n] for n in checks if n.startswith("dq_silver_prices"))


def test_empty_tables_and_missing_partitions(spark, tmp_path):
    given = tables(spark, str(tmp_path))
    empty = {k: v.limit(0) if k != "spark" else v for k, v in given.items()}
    rows = {r.check_name: r for r in quality.check_isolation(names("silver_prices"), empty, RUN).collect()}
    assert {n: (r.status, r.measured_value) for n, r in rows.items()}["dq_daily_prices_missing_partition"] == ("FAIL", 0.0)
    assert rows["dq_silver_prices_null_thresholds"].status == "PASS" and rows["dq_silver_prices_partition_exists"].status == "FAIL"
    assert quality.CHECKS["dq_daily_prices_missing_partition"](given, RUN, {}).first().measured_value == 300
    assert quality.check_isolation([], given, RUN).count() == 0


@pytest.mark.parametrize("name", ["dq_silver_prices_ranges", "dq_gold_prices_table_exists"])
def test_ids_follow_from_names(spark, tmp_path, name):
    given, ids = tables(spark, str(tmp_path)), []
    for run in (RUN, RUN, quality.RunInfo("r2", "j", "2024-01-15", RUN.logged_ts)):
        ids.append(quality.CHECKS[name](given, run, {}).first().check_id)
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 36


def test_market_breadth_leaves_out_rows_without_an_average(spark):
    rows = [(0.1, 10.0, 9.0, None), (-0.1, 8.0, 9.0, None), (0.2, 7.0, None, None), (0.3, None, 5.0, None), (None, 9.0, 1.0, 1.0)]
    day = spark.createDataFrame(rows, "returns_1d double, close double, sma_50 double, sma_200 double")
    assert tuple(A.market_breadth(day).first()) == (75.0, 50.0, None, 4)
