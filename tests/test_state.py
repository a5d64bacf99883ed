"""Daily factors from the stored state against one pass over all days."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotemill import schemas
from quotemill.plans import prices, state
from quotemill.plans.prices import GOLD_COLUMNS, Paths
from quotemill.sources import sinks as S
from quotemill.sources import versions as V

START = date(2020, 1, 1)


def bar(asset, day, price):
    return (asset, f"S{asset}", datetime(day.year, day.month, day.day, 15), price, price + 1, price - 1, price, 10, 1, price, datetime(2026, 1, 1))


def history(n, step, seed, assets=(1, 2, 3)):
    """Bars of n days, `step` days apart, with gaps, a null and a zero price."""
    rng, out = random.Random(seed), []
    for k in range(n):
        day = START + timedelta(days=step * k)
        for a in assets:
            if rng.random() < 0.9:
                price = None if rng.random() < 0.02 else 0.0 if rng.random() < 0.01 else round(rng.uniform(5, 50), 2)
                out.append((a, f"S{a}", datetime(day.year, day.month, day.day, 15), *[price] * 4, 10, 1, price, datetime(2026, 1, 1)))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, schemas.SILVER_BARS).coalesce(1)


def told(df):
    return sorted((tuple(r) for r in df.select(*GOLD_COLUMNS).collect()), key=str)


def test_a_day_equals_the_backfill_whatever_its_rows_span(spark):
    bars = table(spark, history(300, 3, 1))  # 252 rows span over two years
    full = prices.gold_prices_backfill(bars).cache()
    daily = full.select("asset_id", "symbol", "trade_date", "open", "high", "low", "close", "volume", "trade_count", "vwap")
    for k in (0, 1, 22, 150, 252, 253, 299):
        day = START + timedelta(days=3 * k)
        kept = state.build_state(daily.where(F.col("trade_date") < F.lit(day)), day)
        one = state.state_factors(daily.where(F.col("trade_date") == F.lit(day)), kept).withColumn("sentiment_score", F.lit(None).cast("double"))
        assert told(one) == told(full.where(F.col("trade_date") == F.lit(day))), k


def run(spark, paths, bars, days):
    for day in days:
        S.sink_replace_day(bars.where(F.col("timestamp").cast("date") == F.lit(day)), paths.table("silver", "prices"))
        counts = state.gold_prices_stateful(spark, paths, day)
    return counts


def stored(spark, paths):
    return V.load(spark, paths.table("gold", "prices_by_state"))


@pytest.fixture
def paths(spark, tmp_path):
    found = Paths(str(tmp_path))
    spark.createDataFrame([(a, f"S{a}", True) for a in (1, 2, 3)], "asset_id long, symbol string, is_active boolean").write.parquet(found.table("silver", "assets"))
    return found


def test_days_one_by_one_and_late_bars(spark, paths, monkeypatch):
    rows = history(6, 1, 3) + [bar(3, START + timedelta(days=2), 30.0)]
    rows = list({(r[0], r[2]): r for r in rows}.values())
    days = [START + timedelta(days=k) for k in range(6)]
    late = [r for r in rows if not (r[0] == 3 and r[2].date() == days[2])]
    made = []
    build = state.build_state
    monkeypatch.setattr(state, "build_state", lambda *a: made.append(a) or build(*a))
    assert run(spark, paths, table(spark, late), days)[1] == 0
    assert not made  # the stored state was enough each day
    assert told(stored(spark, paths)) == told(prices.gold_prices_backfill(table(spark, late)))
    # the bars that lacked come in
    whole = table(spark, rows)
    assert run(spark, paths, whole, [days[2]])[1] == sum(r[2].date() == days[2] for r in late)
    assert told(stored(spark, paths)) == told(prices.gold_prices_backfill(whole))
    # and the state is that of all rows
    got = V.load(spark, paths.table("gold", "price_state"))
    assert sorted(map(str, got.collect())) == sorted(map(str, build(prices.gold_prices_backfill(whole), days[-1]).collect()))
    # a day built again changes nothing
    assert run(spark, paths, whole, [days[-1]])[1] == sum(r[2].date() == days[-1] for r in rows)
    assert told(stored(spark, paths)) == told(prices.gold_prices_backfill(whole))


def test_a_crash_between_the_two_tables_is_mended(spark, paths, monkeypatch):
    bars = table(spark, [bar(1, START + timedelta(days=k), 10.0 + k) for k in range(4)])
    days = [START + timedelta(days=k) for k in range(4)]
    run(spark, paths, bars, days[:2])

    def crash(*a):
        raise OSError("crash")

    with monkeypatch.context() as m:
        m.setattr(state, "next_state", crash)
        with pytest.raises(OSError):
            run(spark, paths, bars, [days[2]])
    run(spark, paths, bars, [days[3]])  # the state is of day 1, the rows of day 2
    assert told(stored(spark, paths)) == told(prices.gold_prices_backfill(bars))


def test_rings_hold_the_last_rows_only(spark):
    bars = table(spark, history(260, 1, 5, assets=(1,)))
    kept = state.build_state(prices.gold_prices_backfill(bars), START).first()
    assert len(kept.ring) <= 252
    more = state.next_state(state.build_state(prices.gold_prices_backfill(bars), START), spark.createDataFrame([(1, date(2021, 1, 1), 5.0), (9, date(2021, 1, 1), 6.0)], "asset_id long, trade_date date, close double"), date(2021, 1, 1))
    rings = {r.asset_id: r.ring for r in more.collect()}
    assert rings[1][-1].close == 5.0 and len(rings[1]) <= 252 and rings[1][0].trade_date >= kept.ring[0].trade_date and len(rings[9]) == 1
