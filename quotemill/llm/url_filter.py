"""URL verdicts: host and path rules first, else a weighted vocabulary.

The vocabulary is matched by one Aho-Corasick pass over the lower-cased url. A hit counts
only where it is bounded: the characters beside it are not ASCII letters or digits. One
strict term rejects; soft terms reject when at least `min_soft` different ones are found
and their weights sum to `threshold`. A null or blank url has no terms and is allowed.
Urls are read whole, however long; of rules of equal length the first listed wins (none
can fit one url both, but for repeats); repeated rows are judged alike; only the id and
the url are read, so other columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import string

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Terms that reject alone.
STRICT = ["casino", "porn", "xxx", "pills", "viagra", "cialis", "escort", "spam", "warez", "jackpot", "payday-loan", "hentai"]
#: Terms that reject together, with their weights.
SOFT = {
    "bet": 0.5, "bets": 0.5, "betting": 0.6, "free": 0.4, "win": 0.4, "winner": 0.5, "cheap": 0.5, "ads": 0.5, "ad": 0.4, "track": 0.4, "tracker": 0.4, "click": 0.4, "clicks": 0.4,
    "bonus": 0.5, "poker": 0.6, "slots": 0.6, "loan": 0.5, "loans": 0.5, "adult": 0.6, "dating": 0.5, "hot": 0.3, "deal": 0.3, "deals": 0.3, "discount": 0.4, "buy": 0.3, "farm": 0.3, "torrent": 0.5, "crack": 0.4, "prize": 0.5, "crypto": 0.3,
}
#: (verdict, host, path): a rule fits its host and every subdomain where the url's path starts with its path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]

_machines: dict = {}
_BORDER = frozenset(string.ascii_lowercase + string.digits)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without `://`."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The rule that fits with the longest `host` + `path`, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, at, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule, verdict = F.when(fits, at + start).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def term_hits(url: str, machine) -> set[str]:
    """Different terms of the machine that stand bounded in `url`."""
    found = set()
    for end, term in machine.iter(url):
        before = url[end - len(term)] if end >= len(term) else ""
        after = url[end + 1] if end + 1 < len(url) else ""
        if before not in _BORDER and after not in _BORDER:
            found.add(term)
    return found


def vocabulary_rejects(url: Column, strict: list[str] = STRICT, soft: dict[str, float] = SOFT, min_soft: int = 2, threshold: float = 0.7) -> Column:
    """True where the vocabulary rejects the url."""
    weights = {**dict.fromkeys(strict, None), **{k: v for k, v in soft.items() if k not in strict}}

    @F.pandas_udf("boolean")
    def judge(urls: pd.Series) -> pd.Series:
        import ahocorasick

        key = tuple(weights.items())
        if key not in _machines:
            _machines[key] = machine = ahocorasick.Automaton()
            for term in weights:
                machine.add_word(term, term)
            machine.make_automaton()
        machine = _machines[key]

        def rejects(value) -> bool:
            found = [weights[t] for t in term_hits(value.lower(), machine)] if value else []
            light = [w for w in found if w is not None]
            return len(light) < len(found) or len(light) >= min_soft and sum(light) >= threshold - 1e-9

        return urls.map(rejects).astype(bool)

    return judge(url)


def judge_urls(pages: DataFrame, url: str = "url", rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Add host, path, rule and verdict to `pages`."""
    host, path = url_parts(F.col(url))
    parts = pages.withColumns({"host": host, "path": path})
    rule, said = longest_rule(F.col("host"), F.col("path"), rules)
    judged = parts.withColumns({"rule": rule, "_said": said})
    judged = judged.withColumn("_bad", vocabulary_rejects(F.when(F.col("_said").isNull(), F.col(url))))  # only where no rule decides
    return judged.withColumn("verdict", F.coalesce("_said", F.when(F.col("_bad"), "block").otherwise("allow"))).drop("_said", "_bad")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    text = lambda x: "'" + x.replace("'", "''") + "'"
    rules = " ".join(f"WHEN (host = {text(h)} OR ends_with(host, {text('.' + h)})) AND starts_with(path, {text(p)}) THEN {text(h + p + '|' + said)}" for said, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r)))
    pattern = lambda t: text(f"(^|[^a-z0-9]){t}($|[^a-z0-9])")
    strict = " OR ".join(f"regexp_matches(low, {pattern(t)})" for t in STRICT)
    soft = [f"CASE WHEN regexp_matches(low, {pattern(t)}) THEN 1 ELSE 0 END" for t in SOFT]
    weight = " + ".join(f"{w} * ({s})" for w, s in zip(SOFT.values(), soft))
    return f"""
    WITH a AS (SELECT page_id, coalesce(lower(url), '') AS low, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
    b AS (SELECT page_id, low, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
    c AS (SELECT *, CASE {rules} END AS hit, ({strict}) AS strict, {' + '.join(soft)} AS n, {weight} AS w FROM b)
    SELECT page_id, host, path, split_part(hit, '|', 1) AS rule,
      CASE WHEN hit IS NOT NULL THEN split_part(hit, '|', 2) WHEN strict OR (n >= 2 AND w >= 0.7 - 1e-9) THEN 'block' ELSE 'allow' END AS verdict FROM c"""


ORACLE_SQL = _sql()
