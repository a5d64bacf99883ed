"""Scalar column logic. Arguments are Columns or column names."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Two-part public suffixes after which a third label belongs to the base domain (fixed values).
TWO_PART_SUFFIXES = ["co.uk", "com.au", "com.br", "com.mx", "com.sg", "com.hk", "com.tw", "com.tr", "co.jp", "co.in", "co.kr", "co.nz", "co.za"]
#: Domains of publishers whose names do not show them (fixed values).
PUBLISHER_DOMAINS = {
    "associated press": "apnews.com",
    "axios": "axios.com",
    "bloomberg": "bloomberg.com",
    "cnbc": "cnbc.com",
    "financial times": "ft.com",
    "fortune": "fortune.com",
    "marketwatch": "marketwatch.com",
    "reuters": "reuters.com",
    "the wall street journal": "wsj.com",
    "wall street journal": "wsj.com",
    "the new york times": "nytimes.com",
    "new york times": "nytimes.com",
    "the washington post": "washingtonpost.com",
    "washington post": "washingtonpost.com",
    "yahoo finance": "yahoo.com",
}
#: Articles of company names that no rule gives (fixed values).
ARTICLES = {"Marsh": "Marsh_(company)"}
DEFAULT_WEIGHT = 0.05


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """The value as it is, or null where it is empty after trimming."""
    return F.when(F.trim(col(c)) != "", col(c))


def norm_symbol(c: Column | str) -> Column:
    return F.upper(F.trim(col(c)))


def norm_publisher(c: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(col(c))), F.lit(""))


def base_domain(c: Column | str, suffixes: list[str] = TWO_PART_SUFFIXES) -> Column:
    """Last two labels of a host, or three where the last two are a listed suffix; '' for null or blank."""
    host = F.regexp_replace(F.coalesce(F.lower(F.trim(col(c))), F.lit("")), r"^www\.", "")
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    last = lambda n: F.array_join(F.slice(labels, -n, n), ".")
    two = F.when(F.size(labels) >= 2, last(2)).otherwise(F.array_join(labels, "."))
    return F.when((F.size(labels) >= 3) & two.isin(suffixes), last(3)).otherwise(two)


def publisher_domain(name: Column | str, override: Column | str) -> Column:
    """The override where given, else the base domain of a name that looks like one, else ''."""
    clean = norm_publisher(name)
    looks = clean.contains(".") & ~clean.contains(" ")
    return F.coalesce(blank_to_null(override), F.when(looks, base_domain(clean)).otherwise(""))


def rank_to_weight(rank: Column | str, default: float = DEFAULT_WEIGHT) -> tuple[Column, Column]:
    """(weight, source): 1 - log10(rank) / 6 within [default, 1]; no rank or one below 1 gives the default."""
    r = col(rank)
    ranked = r.isNotNull() & (r > 0)
    weight = F.when(ranked, F.least(F.lit(1.0), F.greatest(F.lit(float(default)), 1 - F.log10(F.when(ranked, r)) / 6))).otherwise(float(default))
    return weight, F.when(ranked, "tranco").otherwise("default")


def sentiment_value(c: Column | str) -> Column:
    label = F.lower(col(c))
    return F.when(label == "positive", 1.0).when(label == "neutral", 0.0).when(label == "negative", -1.0)


def headline_text(title: Column | str, summary: Column | str) -> Column:
    return F.coalesce(blank_to_null(title), blank_to_null(summary), F.lit(""))


def dedupe_key(symbol: Column | str, uuid: Column | str, link: Column | str, title: Column | str) -> Column:
    """`SYMBOL::story`; nulls count as empty."""
    story = F.coalesce(blank_to_null(uuid), blank_to_null(link), blank_to_null(title), F.lit(""))
    return F.concat_ws("", F.upper(col(symbol)), F.lit("::"), story)


#: Endings of company names that an article's title does not carry, in order (fixed values).
NAME_ENDINGS = [r"\s+Class\s+[A-Z]\s+Common\s+Stock$", r"\s+Common\s+Stock$", r"\s+Class\s+[A-Z]$", r"\s+Ordinary\s+Shares$", r"\s+ADS$"]


def article_from_name(c: Column | str, override: Column | str | None = None) -> Column:
    name = clean = F.trim(col(c))
    for ending in NAME_ENDINGS:
        name = F.regexp_replace(name, "(?i)" + ending, "")
    derived = F.replace(name, F.lit(" "), F.lit("_"))
    for known, article in ARTICLES.items():
        derived = F.when(clean == known, article).otherwise(derived)
    return derived if override is None else F.coalesce(blank_to_null(override), derived)


def article_title(c: Column | str) -> Column:
    """Trim, percent-decode once (a plus stays), blanks to underscores; undecodable text stays as it is."""
    text = F.trim(col(c))
    decoded = F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)
    return F.replace(decoded, F.lit(" "), F.lit("_"))


def article_choice(title: Column | str, name: Column | str) -> Column:
    return F.coalesce(blank_to_null(article_title(title)), article_from_name(name))


def parse_view_date(c: Column | str, as_of: date) -> Column:
    text = F.substring(col(c), 1, 10)
    return F.coalesce(F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd"))), F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))), F.lit(as_of).cast("date"))


def epoch_to_ts(c: Column | str) -> Column:
    return F.timestamp_seconds(col(c))


def dollar_volume(close: Column | str, volume: Column | str) -> Column:
    return col(close) * col(volume)


def candle_body(open_: Column | str, close: Column | str) -> Column:
    """struct(body_low, body_high, direction)."""
    direction = F.when(col(close) >= col(open_), "up").otherwise("down")
    return F.struct(F.least(col(open_), col(close)).alias("body_low"), F.greatest(col(open_), col(close)).alias("body_high"), direction.alias("direction"))


def symbol_label(symbol: Column | str, name: Column | str) -> Column:
    return F.concat_ws(" - ", col(symbol), blank_to_null(name))


def pct_scale(c: Column | str) -> Column:
    return col(c) * 100


def details_json(**columns: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in columns.items()]))


def metadata_int(json: Column | str, *aliases: str) -> Column:
    """The first of the keys with a whole number; booleans and fractions count as absent."""
    return fields_int(metadata_fields(json), *aliases)


def metadata_fields(json: Column | str) -> Column:
    """The document's keys, parsed once, with the text of their values."""
    return F.from_json(col(json), "map<string,string>")


def fields_int(fields: Column, *aliases: str) -> Column:
    """`metadata_int` of parsed fields."""

    def whole(key: str) -> Column:
        text = F.try_element_at(fields, F.lit(key))
        found = F.coalesce(F.get_json_object(text, "$.value"), text)
        number = F.when(~F.lower(found).isin("true", "false"), found.try_cast("double"))
        return F.when(number == F.floor(number), number.try_cast("long"))

    return F.coalesce(*map(whole, aliases))


def check_id(*names: str | None) -> Column:
    """A random id; with names one that they alone decide, so that a repeated run gives its rows the same ids."""
    if not names:
        return F.uuid()
    return F.lit(str(uuid.uuid5(uuid.NAMESPACE_OID, "\x1f".join("" if n is None else n for n in names))))


def add_column_if_missing(df: DataFrame, name: str, dtype, fill=None) -> DataFrame:
    """The column cast to its type where absent (null, or `fill`); with `fill`, nulls of a present one are filled too."""
    value = F.lit(fill).cast(dtype)
    if name not in df.columns:
        return df.withColumn(name, value)
    return df if fill is None else df.withColumn(name, F.coalesce(F.col(name), value))
