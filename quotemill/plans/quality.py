"""Data-quality and freshness checks. A check turns tables into one row of CHECK_ROW.

Each is a function by name, in CHECKS, made of the counts it needs and its verdict on them;
`check_isolation` runs many as one job that scans each table once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.calendar import is_trading_day
from ..functions.columns import check_id, col, details_json, norm_symbol
from ..operators.joins import anti_missing_symbols
from ..operators.topk import missing_symbol_sample
from ..sources.readers import schema_probe
from ..sources.sinks import append_log, append_once

#: Names and prefixes whose severity is YELLOW (fixed values).
YELLOW_PREFIXES = ["dq_silver_ref_sp500_", "dq_bronze_tranco_"]
YELLOW_CHECKS = [
    "dq_sp500_update",
    "dq_tranco_update",
    "dq_daily_prices_missing_partition",
    "dq_daily_news_missing_partition",
    "dq_wikipedia_activity_missing_partition",
    "dq_silver_news_partition_exists",
    "dq_silver_wikipedia_partition_exists",
    "dq_silver_news_null_threshold_title_or_link",
    "dq_silver_wikipedia_null_threshold_asset_id",
    "dq_silver_prices_schema_range_columns",
    "dq_gold_prices_schema_range_columns",
    "dq_daily_prices",
    "dq_daily_news",
    "dq_wikipedia_activity",
    "dq_asset_status_updates",
]
YELLOW_FRESHNESS = ["daily_news_partition_row_count", "wikipedia_assets_with_views_min_count"]

#: Columns each table must have (fixed values).
REQUIRED = {
    "silver_prices": ["asset_id", "symbol", "timestamp", "open", "high", "low", "close", "volume", "ingested_ts"],
    "silver_prices_range": ["trade_count", "vwap"],
    "gold_prices": ["asset_id", "symbol", "trade_date", "open", "high", "low", "close", "volume", "dollar_volume"],
    "gold_prices_range": ["trade_count", "vwap", "realized_vol_21d"],
    "silver_news": ["asset_id", "symbol", "uuid", "title", "publisher_id", "link", "provider_publish_time", "type", "summary", "query_date", "ingested_ts"],
    "silver_pageviews": ["asset_id", "granularity", "view_date", "views", "ingested_ts"],
    "constituents": ["symbol", "security", "asset_id"],
    "assets": ["asset_id", "symbol", "is_active"],
}


@dataclass
class RunInfo:
    """The run that a check row belongs to."""

    run_id: str
    job_name: str
    partition_key: str | None
    logged_ts: datetime


def dq_severity(check_name: Column, threshold: Column) -> Column:
    yellow = check_name.isin(YELLOW_CHECKS)
    for prefix in YELLOW_PREFIXES:
        yellow = yellow | check_name.startswith(prefix)
    return F.when(yellow | (check_name.contains("null_threshold") & (F.coalesce(threshold, F.lit(0.0)) > 0)), "YELLOW").otherwise("RED")


def freshness_severity(check_name: Column) -> Column:
    return F.when(check_name.isin(YELLOW_FRESHNESS), "YELLOW").otherwise("RED")


COLUMNS = [f.name for f in schemas.CHECK_ROW.fields]


def row(run: RunInfo, name: str, measured: Column, threshold: float | None = 0.0, failed: Column | None = None, severity: Column | None = None, status: Column | None = None, **details: Column) -> Column:
    """A check row as a struct: FAIL where `failed` (or measured above threshold), unless `status` says."""
    limit, label = F.lit(threshold).cast("double"), F.lit(name)
    failed = (measured > limit) if failed is None else failed
    values = {
        "check_id": check_id(run.run_id, run.partition_key, name), "run_id": F.lit(run.run_id), "job_name": F.lit(run.job_name), "partition_key": F.lit(run.partition_key).cast("string"), "check_name": label,
        "severity": dq_severity(label, limit) if severity is None else severity, "status": F.when(failed, "FAIL").otherwise("PASS") if status is None else status, "measured_value": measured.cast("double"), "threshold_value": limit,
        "details_json": details_json(**details) if details else F.lit("{}"), "logged_ts": F.lit(run.logged_ts).cast("timestamp"),
    }
    return F.struct(*[values[c].alias(c) for c in COLUMNS])


def rows_of(frame: DataFrame, structs: list[Column]) -> DataFrame:
    """A row for each struct, from a one-row frame."""
    return frame.select(F.inline(F.array(*structs)))


def check_row(measured: DataFrame, run: RunInfo, name: str, threshold: float | None = 0.0, failed: Column | None = None, severity: Column | None = None, **details: Column) -> DataFrame:
    """A check row from a one-row frame with `measured`."""
    return rows_of(measured, [row(run, name, F.col("measured"), threshold, failed, severity, **details)])


def fixed(run: RunInfo, name: str, status: str, measured: float | None = None, threshold: float | None = 0.0, reason: str = "", severity: Column | None = None) -> Column:
    """A check row that needs no count."""
    return row(run, name, F.lit(measured).cast("double"), threshold, severity=severity, status=F.lit(status), reason=F.lit(reason))


def fixed_row(spark: SparkSession, run: RunInfo, name: str, status: str, measured: float | None = None, threshold: float | None = 0.0, reason: str = "", severity: Column | None = None) -> DataFrame:
    return rows_of(spark.range(1), [fixed(run, name, status, measured, threshold, reason, severity)])


@dataclass(frozen=True)
class Check:
    """A check of one table, as what it counts and the row that the counts give.

    `flags` are conditions whose rows are counted; `keys` are (columns, condition) whose
    groups and surplus rows are. The verdict finds them as `name`, `name.groups` and
    `name.excess`, and the table's size as `rows`. `decide` gives a row without counting.
    """

    name: str
    table: str
    verdict: Callable[[dict[str, Column], RunInfo, dict], Column]
    flags: Callable[[], dict[str, Column]] = dict
    keys: Callable[[], dict[str, tuple[list, Column | None]]] = dict
    decide: Callable[[dict, RunInfo], Column | None] = lambda tables, run: None

    def __call__(self, tables: dict, run: RunInfo, thresholds: dict) -> DataFrame:
        decided = self.decide(tables, run)
        return rows_of(tables["spark"].range(1), [decided]) if decided is not None else judged(tables[self.table], [self], run, thresholds)


#: Flags of one number.
BITS = 60


def measured(df: DataFrame, checks: list[Check]) -> tuple[DataFrame, dict[str, dict[str, Column]]]:
    """All counts of the checks as one row, from one scan and one shuffle; and where each check finds its own.

    A row is told apart by its flags, packed into numbers, and expanded once for each set
    of keys. Rows are counted by flags and keys together, so flags cost no more groups than
    there are combinations of them; the counts of the groups then add up to all measures.
    """
    flags = [(c.name, k, v) for c in checks for k, v in c.flags().items()]
    keys = [(c.name, k, [col(x) for x in columns], where) for c in checks for k, (columns, where) in c.keys().items()]
    packed = [reduce(lambda x, y: x + y, [F.when(F.coalesce(v, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, _, v) in enumerate(flags[a : a + BITS])]) for a in range(0, len(flags), BITS)]
    slots = [(s, j, c) for s, (_, _, columns, _) in enumerate(keys) for j, c in enumerate(columns)]
    kinds = [f.dataType for f in df.select(*[c.alias(f"k{s}_{j}") for s, j, c in slots]).schema.fields]
    sets = []
    for s in range(-1, len(keys)):
        bits = [(v if s < 0 else F.lit(None).cast("long")).alias(f"b{i}") for i, v in enumerate(packed)]
        own = [(c if s == t else F.lit(None).cast(kind)).alias(f"k{t}_{j}") for (t, j, c), kind in zip(slots, kinds)]
        one = F.struct(F.lit(s).alias("set"), *bits, *own)
        sets.append(one if s < 0 or keys[s][3] is None else F.when(keys[s][3], one))
    names = ["set", *[f"b{i}" for i in range(len(packed))], *[f"k{s}_{j}" for s, j, _ in slots]]
    expanded = df.select(F.explode(F.array(*sets)).alias("e")).where("e IS NOT NULL").select("e.*")
    counts = expanded.groupBy(*names).agg(F.count("*").alias("n"))
    total = lambda where, n: F.coalesce(F.sum(F.when(where, n)), F.lit(0))
    of = lambda s: F.col("set") == s
    out, found = [total(of(-1), F.col("n")).alias("rows")], {c.name: {"rows": F.col("rows")} for c in checks}
    for i, (name, k, _) in enumerate(flags):
        out.append(total(of(-1) & (F.col(f"b{i // BITS}").bitwiseAND(F.lit(1 << i % BITS).cast("long")) != 0), F.col("n")).alias(f"f{i}"))
        found[name][k] = F.col(f"f{i}")
    for s, (name, k, _, _) in enumerate(keys):
        out += [total(of(s), F.col("n") - 1).alias(f"x{s}"), F.count_if(of(s)).alias(f"g{s}")]
        found[name] |= {f"{k}.excess": F.col(f"x{s}"), f"{k}.groups": F.col(f"g{s}")}
    return counts.agg(*out), found


def judged(df: DataFrame, checks: list[Check], run: RunInfo, thresholds: dict) -> DataFrame:
    """The rows of the checks of one table."""
    frame, found = measured(df, checks)
    return rows_of(frame, [c.verdict(found[c.name], run, thresholds) for c in checks])


def _share(part: Column, rows: Column) -> Column:
    return F.coalesce(F.try_divide(part, rows), F.lit(0.0))


def _missing(c: str, blank: tuple[str, ...] = ()) -> Column:
    return _blank(c) if c in blank else F.col(c).isNull()


def _uniqueness(table: str, name: str, *key_sets: list, where=None) -> Check:
    """Rows that repeat an earlier one by a set of keys."""

    def verdict(m, run, thresholds):
        return row(run, name, reduce(lambda x, y: x + y, [m[f"key{i}.excess"] for i in range(len(key_sets))]))

    return Check(name, table, verdict, keys=lambda: {f"key{i}": (k() if callable(k) else k, where() if where else None) for i, k in enumerate(key_sets)})


def _nulls(table: str, name: str, cols: list[str], blank: tuple[str, ...], key: str, default: float = 0.0) -> Check:
    """The largest share of missing values of a column."""

    def verdict(m, run, thresholds):
        shares = [_share(m[f"null_{c}"], m["rows"]) for c in cols]
        return row(run, name, F.greatest(*shares), thresholds.get(key, default), row_count=m["rows"], **{f"null_{c}": m[f"null_{c}"] for c in cols})

    return Check(name, table, verdict, flags=lambda: {f"null_{c}": _missing(c, blank) for c in cols})


def _least(table: str, name: str, least: float = 1.0, measure: str = "rows", freshness: bool = False, key: str = "", most: int | None = None, **more) -> Check:
    """FAIL where a count is below the least."""

    def verdict(m, run, thresholds):
        limit, value = thresholds.get(key, least), m[measure]
        value = value if most is None else F.least(value, F.lit(most).cast("long"))
        return row(run, name, value, limit, value < limit, freshness_severity(F.lit(name)) if freshness else None)

    return Check(name, table, verdict, **more)


def _exists(table: str, name: str) -> Check:
    return _least(table, name, decide=lambda tables, run: fixed(run, name, "FAIL", 0.0, 1.0, "missing") if tables.get(table) is None else None)


def _table_exists(table: str, name: str) -> Check:
    def decide(tables, run):
        found = tables.get(table) is not None
        return fixed(run, name, "PASS" if found else "FAIL", float(found), 1.0)

    return Check(name, table, lambda m, run, thresholds: None, decide=decide)


def _columns(table: str, name: str, required: list[str]) -> Check:
    def decide(tables, run):
        missing = schema_probe(tables[table], set(required))
        return fixed(run, name, "FAIL" if missing else "PASS", float(len(missing)), 0.0, ",".join(missing))

    return Check(name, table, lambda m, run, thresholds: None, decide=decide)


def price_rules(gold: bool = False) -> list[Column]:
    """What no price row may do."""
    c = F.col
    signs = ["open", "high", "low", "close", "volume", "trade_count", "vwap"] + ["dollar_volume", "realized_vol_21d"] * gold
    order = [c("high") < c("low"), c("open") > c("high"), c("open") < c("low"), c("close") > c("high"), c("close") < c("low")]
    return [c(x) < 0 for x in signs] + order


def _ranges(table: str, name: str, rules, required: list[str] = ()) -> Check:
    """Rows that break a rule; a null operand breaks none."""

    def decide(tables, run):
        if missing := schema_probe(tables[table], set(required)):
            return fixed(run, name, "SKIPPED", None, 0.0, "missing_range_columns: " + ",".join(missing))
        return None

    broken = lambda: reduce(lambda x, y: x | y, [F.coalesce(r, F.lit(False)) for r in rules()])
    return Check(name, table, lambda m, run, thresholds: row(run, name, m["broken"]), flags=lambda: {"broken": broken()}, decide=decide)


def _share_of(table: str, name: str, bad, key: str, default: float) -> Check:
    def verdict(m, run, thresholds):
        return row(run, name, _share(m["bad"], m["rows"]), thresholds.get(key, default), row_count=m["rows"], missing=m["bad"])

    return Check(name, table, verdict, flags=lambda: {"bad": bad()})


def _sp500_nulls(m, run, thresholds):
    most = {"symbol": thresholds.get("sp500_symbol", 0.0), "asset_id": thresholds.get("sp500_asset_id", 0.25)}
    symbol, asset = (_share(m[f"null_{c}"], m["rows"]) for c in ("symbol", "asset_id"))
    return row(run, "dq_silver_ref_sp500_null_thresholds", F.greatest(symbol, asset), max(most.values()), (symbol > most["symbol"]) | (asset > most["asset_id"]), symbol=symbol, asset_id=asset)


def _readable(m, run, thresholds):
    return row(run, "dq_active_symbols_source_silver_assets_readable", m["active"], 1.0, status=F.when(m["active"] < 1, "WARN").otherwise("PASS"))


def _missing_partition(table: str, name: str) -> Check:
    """SKIPPED without a partition key; with one the day's table must have rows."""

    def decide(tables, run):
        return fixed(run, name, "SKIPPED", None, None, "no partition key") if run.partition_key is None else None

    return _least(table, name, decide=decide)


def _story_keys() -> list:
    story = F.coalesce(F.nullif("uuid", F.lit("")), F.nullif("link", F.lit("")), F.nullif("title", F.lit("")))
    return [norm_symbol("symbol"), story, F.col("provider_publish_time")]


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(c) == "")


def _active() -> Column:
    return F.col("is_active") & (F.trim("symbol") != "")


def _coverage(tables, run, thresholds):
    """Active symbols without a price; skipped without a key and on days without trading (weekends, and table `holidays` where it is given)."""
    name = "prices_active_symbol_coverage"
    key = tables["spark"].range(1).select(F.lit(run.partition_key).cast("string").alias("day"))
    severity = freshness_severity(F.lit(name))
    if not is_trading_day(key, "day", tables.get("holidays")).first()["is_trading_day"]:
        return fixed_row(tables["spark"], run, name, "SKIPPED", None, 0.0, "no trading day", severity)
    missing = missing_symbol_sample(anti_missing_symbols(tables["assets"].where(_active()), tables["prices"])).withColumnRenamed("missing_count", "measured")
    return check_row(missing, run, name, 0.0, severity=severity, missing_symbols=F.col("sample"))


_SYMBOL = lambda: [norm_symbol("symbol")]
_RANK_RULES = lambda: [F.col("rank").isNull(), F.col("rank") < 1, F.col("rank") > 1_000_000, _blank("domain")]
_SEEN = lambda: {"seen": (["asset_id"], F.col("views").isNotNull() & F.col("asset_id").isNotNull())}

#: Every check by name: (tables, run, thresholds) -> one row.
CHECKS = {c.name: c for c in [
    _uniqueness("assets", "dq_silver_assets_active_symbol_uniqueness", _SYMBOL, where=_active),
    _exists("silver_prices", "dq_silver_prices_partition_exists"),
    _columns("silver_prices", "dq_silver_prices_schema_required_columns", REQUIRED["silver_prices"]),
    _columns("silver_prices", "dq_silver_prices_schema_range_columns", REQUIRED["silver_prices_range"]),
    _uniqueness("silver_prices", "dq_silver_prices_uniqueness_asset_id_timestamp", ["asset_id", "timestamp"]),
    _nulls("silver_prices", "dq_silver_prices_null_thresholds", REQUIRED["silver_prices"][:8], ("symbol",), "prices_null"),
    _ranges("silver_prices", "dq_silver_prices_ranges", price_rules, REQUIRED["silver_prices_range"]),
    _table_exists("gold_prices", "dq_gold_prices_table_exists"),
    _columns("gold_prices", "dq_gold_prices_schema_required_columns", REQUIRED["gold_prices"]),
    _columns("gold_prices", "dq_gold_prices_schema_range_columns", REQUIRED["gold_prices_range"]),
    _uniqueness("gold_prices", "dq_gold_prices_uniqueness_asset_id_trade_date", ["asset_id", "trade_date"]),
    _nulls("gold_prices", "dq_gold_prices_core_null_thresholds", REQUIRED["gold_prices"], ("symbol",), "gold_prices_null"),
    _ranges("gold_prices", "dq_gold_prices_ranges", lambda: price_rules(True), REQUIRED["gold_prices_range"]),
    _exists("silver_news", "dq_silver_news_partition_exists"),
    _columns("silver_news", "dq_silver_news_schema_required_columns", REQUIRED["silver_news"]),
    _uniqueness("silver_news", "dq_silver_news_uniqueness_symbol_story_publish_time", _story_keys),
    _share_of("silver_news", "dq_silver_news_null_threshold_title_or_link", lambda: _blank("title") & _blank("link"), "news_title_link", 0.0),
    _exists("silver_pageviews", "dq_silver_wikipedia_partition_exists"),
    _columns("silver_pageviews", "dq_silver_wikipedia_schema_required_columns", REQUIRED["silver_pageviews"]),
    _uniqueness("silver_pageviews", "dq_silver_wikipedia_uniqueness_asset_id_view_date_granularity", ["asset_id", "view_date", "granularity"]),
    _share_of("silver_pageviews", "dq_silver_wikipedia_null_threshold_asset_id", lambda: F.col("asset_id").isNull(), "pageviews_asset_id", 0.25),
    _ranges("silver_pageviews", "dq_silver_wikipedia_range_views_non_negative", lambda: [F.col("views") < 0]),
    _table_exists("constituents", "dq_silver_ref_sp500_table_exists"),
    _columns("constituents", "dq_silver_ref_sp500_schema_required_columns", REQUIRED["constituents"]),
    _uniqueness("constituents", "dq_silver_ref_sp500_uniqueness_symbol", _SYMBOL),
    Check("dq_silver_ref_sp500_null_thresholds", "constituents", _sp500_nulls, flags=lambda: {f"null_{c}": _missing(c, ("symbol",)) for c in ("symbol", "asset_id")}),
    _exists("ranks", "dq_bronze_tranco_snapshot_exists"),
    _least("ranks", "dq_bronze_tranco_schema_rank_domain", most=1, flags=lambda: {"there": F.col("rank").isNull() | F.col("domain").isNull()}),
    _uniqueness("ranks", "dq_bronze_tranco_uniqueness_rank_and_domain", ["rank"], lambda: [F.lower(F.trim("domain"))]),
    _ranges("ranks", "dq_bronze_tranco_ranges", _RANK_RULES),
    _table_exists("assets", "dq_silver_assets_table_exists"),
    _columns("assets", "dq_silver_assets_schema_required_columns", REQUIRED["assets"]),
    _uniqueness("assets", "dq_silver_assets_uniqueness_asset_id_and_symbol", ["asset_id"], _SYMBOL),
    _nulls("assets", "dq_silver_assets_null_thresholds", REQUIRED["assets"], ("symbol",), "assets_null"),
    _missing_partition("silver_prices", "dq_daily_prices_missing_partition"),
    _missing_partition("silver_news", "dq_daily_news_missing_partition"),
    _missing_partition("silver_pageviews", "dq_wikipedia_activity_missing_partition"),
    Check("dq_active_symbols_source_silver_assets_readable", "assets", _readable, flags=lambda: {"active": _active()}),
    _least("silver_pageviews", "wikipedia_assets_with_views_min_count", 400.0, "seen.groups", True, "min_assets_with_views", keys=_SEEN),
    _least("silver_news", "daily_news_partition_row_count", freshness=True),
]} | {"prices_active_symbol_coverage": _coverage}


def check(name: str):
    """The check of that name."""
    return CHECKS[name]


def _failed(run: RunInfo, name: str, e: Exception) -> Column:
    return fixed(run, name, "FAIL", None, None, f"{type(e).__name__}: {str(e)[:200]}")


def suite(checks: list[str], tables: dict, run: RunInfo, thresholds: dict[str, float] | None = None) -> DataFrame | None:
    """Rows of many checks as one frame with one scan for each table (coverage, a join, has its own); a check that can't be planned is a FAIL row."""
    thresholds, fixed_rows, by_table, frames = thresholds or {}, [], {}, []
    for name in checks:
        try:
            found = CHECKS[name]
            if not isinstance(found, Check):
                frames.append(found(tables, run, thresholds))
            elif (decided := found.decide(tables, run)) is not None:
                fixed_rows.append(decided)
            else:
                judged(tables[found.table], [found], run, thresholds)  # resolves its columns, or raises
                by_table.setdefault(found.table, []).append(found)
        except Exception as e:  # noqa: BLE001
            fixed_rows.append(_failed(run, name, e))
    frames += [judged(tables[t], found, run, thresholds) for t, found in by_table.items()]
    if fixed_rows:
        frames.append(rows_of(tables["spark"].range(1), fixed_rows))
    return reduce(DataFrame.unionByName, frames) if frames else None


def check_isolation(checks: list[str], tables: dict, run: RunInfo, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Rows of all checks as one job; one that raises becomes a FAIL row and the others still run (then one by one)."""
    spark, frame = tables["spark"], suite(checks, tables, run, thresholds)
    if frame is None:
        return spark.createDataFrame([], schemas.CHECK_ROW)
    try:
        rows = frame.collect()  # one row a check
    except Exception:  # noqa: BLE001
        rows = []
        for name in checks:
            try:
                rows += CHECKS[name](tables, run, thresholds or {}).collect()
            except Exception as e:  # noqa: BLE001
                rows += rows_of(spark.range(1), [_failed(run, name, e)]).collect()
    return spark.createDataFrame([tuple(r) for r in rows], schemas.CHECK_ROW)


def write_dq_log(spark: SparkSession, path: str, check_name: str, severity: str, status: str, run: RunInfo, measured: float | None = None, threshold: float | None = None, details: dict[str, str] | None = None, error: Exception | None = None, batch: str | None = None) -> None:
    """Append one row; an error's name and message join the details. With `batch` it is written once whatever the retries (`append_once`)."""
    said = dict(details or {}) | ({"error_name": type(error).__name__, "error_message": str(error)} if error else {})
    row = fixed_row(spark, run, check_name, status, measured, threshold).withColumn("severity", F.lit(severity))
    row = row.withColumn("details_json", details_json(**{k: F.lit(v) for k, v in said.items()}) if said else F.lit("{}"))
    if batch is None:
        append_log(row, path)
    else:
        append_once(row, path, batch)
