"""Every registered query of the library against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from quotemill.plans import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def norm(v):
    return round(v, 6) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(str([norm(dict(zip(columns, r))[c]) for c in sorted(columns)]) for r in found.fetchall())
    assert sorted(str([norm(r[c]) for c in sorted(columns)]) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_without_sql_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() >= 1


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_news_seconds_round_as_in_sql(spark, con, tmp_path):
    """Story times with parts of a second, also just before midnight, halves and times before 1970."""
    odd = ["2024-01-15 23:59:59.700001", "2024-01-15 23:59:59.5", "2024-01-15 23:59:58.5", "2024-01-15 23:59:59.499999", "1969-12-31 23:59:59.6", "1969-12-31 23:59:59.5", "1969-12-31 23:59:59.4"]
    con.execute(f"COPY (SELECT i AS event_id, CAST(t AS TIMESTAMP) AS ts, CASE WHEN i <> 3 THEN i % 2 END AS user_id, 'a\"é\\' AS event_type FROM (VALUES {', '.join(f'({k}, {chr(39)}{t}{chr(39)})' for k, t in enumerate(odd))}, (7, NULL)) v(i, t)) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    want = con.execute(queries.SQL["ingest_news_json"].replace("FROM events", f"FROM '{tmp_path}/events.parquet'")).fetchall()
    got = queries.QUERIES["ingest_news_json"](spark, str(tmp_path)).select("symbol", "uuid", "title", "published").collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, want))


def test_daily_series_are_dealt_once_by_their_rows(spark, monkeypatch):
    """From the table to the factors one exchange, over as many partitions as the number of rows asks."""
    from quotemill.operators import windows
    from quotemill.plans import adapters, prices

    monkeypatch.setattr(windows, "TASK_ROWS", 500, raising=False)
    daily = adapters.daily(spark, SF)
    bars = daily.withColumns({"timestamp": daily["trade_date"].cast("timestamp"), "trade_count": daily["volume"], "vwap": daily["close"]}).drop("trade_date")
    plan = prices.gold_prices_backfill(bars)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    parts = -(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 500)
    assert len(dealt) == 1 and f", {parts})" in dealt[0]
