"""Quality rules by distribution divergence, in DataFrame functions only.

The base rules count words, symbols, repeated lines and repeated 8-word windows. The
method compares each text's character classes and common words with those of all texts
of its language, by the Jensen-Shannon distance (base 2, 0 to 1). A language's common
words are those of 1% or more of its words, at most 100. Guards: a text of fewer than
`min_words` words isn't compared, nor is a language with fewer than `min_reference`
words in all, nor a text without language: these keep the base verdict.

A null or empty text has no words and fails the base rules. Windows are compared by
64-bit hashes. Texts are read whole, however long; words of equal frequency at the limit of
the common ones are taken in order of the word; repeated rows are judged alike, and count
in the reference as often as they occur; only the id, `text` and `lang` are read, so other
columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "symbol", "wide", "other")
WINDOW = 8
MOST_LANGUAGES = 10_000


def let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


BLANK = r"\x20\x09-\x0D"


def _only(text: Column, characters: str) -> Column:
    """How many characters of a text are in the class."""
    return F.char_length(F.regexp_replace(text, f"[^{characters}]+", ""))


def split_words(text: Column) -> Column:
    """`[^\\x20\\x09-\\x0D]+` of a text, in order."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"[{BLANK}]+"))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words in windows of 8 words that occur twice or more."""

    def pairs(h: Column, step: int) -> Column:
        n = F.size(h) - step
        return F.zip_with(F.slice(h, 1, n), F.slice(h, step + 1, n), lambda a, b: F.xxhash64(a, b))

    def covered(h: Column) -> Column:
        def twice(s: Column) -> Column:
            same = lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])
            at = F.filter(F.transform(s, lambda x, i: F.when(same(x, i), x["i"])), lambda i: i.isNotNull())
            start = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
            return F.aggregate(F.sort_array(at), start, lambda a, p: F.struct((a["n"] + F.least(F.lit(window), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

        rows = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(rows, twice)).otherwise(0)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    eights = let(let(let(hashes, lambda h: pairs(h, 1)), lambda h: pairs(h, 2)), lambda h: pairs(h, 4))
    return F.when(F.size(words) > window, let(eights, covered)).otherwise(0)


def repeated_lines(text: Column) -> Column:
    """Number of lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANK}]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def class_counts() -> Column:
    """Characters of a text by CLASSES, from the columns that `with_classes` adds; `wide` counts bytes beyond the first of a character."""
    text, rare, symbols = F.col("_text"), F.col("_rare"), F.col("n_symbols")
    found = {"lower": F.char_length(text) - F.char_length(rare), "upper": _only(rare, "A-Z"), "digit": _only(rare, "0-9"), "space": F.col("_spaces"), "symbol": symbols, "wide": F.octet_length(text) - F.char_length(text)}
    rest = F.char_length(text) - sum((found[k] for k in CLASSES[:-2]), F.lit(0))
    return F.array(*[found.get(k, rest).cast("double") for k in CLASSES])


def with_classes(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with word_chars, n_symbols and what they come from; null texts count as empty."""
    rows = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    rows = rows.withColumn("_rare", F.regexp_replace("_text", "[a-z]+", ""))  # the other classes are looked for in what is left
    rows = rows.withColumns({"_spaces": _only(F.col("_rare"), BLANK), "n_symbols": _only(F.col("_rare"), SYMBOLS.replace("&", r"\&")).cast("long")})
    return rows.withColumn("word_chars", (F.char_length("_text") - F.col("_spaces")).cast("long"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same, with _words and n_words."""
    rows = with_classes(docs, text).withColumn("_words", split_words(F.col("_text")))
    return rows.withColumn("n_words", F.size("_words").cast("long"))


def language_references(docs: DataFrame, min_reference: int = 1000, least_share: float = 0.01, lang: str = "lang", text: str = "text") -> DataFrame:
    """A row for each language: its common words, their shares with the rest's behind them, and its character classes' shares."""
    texts = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(F.col("lang").isNotNull())
    counted = with_classes(texts).select("lang", class_counts().alias("classes"))
    sums = counted.groupBy("lang").agg(*[F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(len(CLASSES))])
    words = texts.select("lang", F.explode(split_words(F.coalesce("text", F.lit("")))).alias("word"))
    counts = shared.keep(words.groupBy("lang", "word").count(), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("count").alias("total")).where(F.col("total") >= min_reference)
    totals = shared.keep(totals.join(sums, "lang"), "language-totals")
    if totals.count() > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    totals = F.broadcast(totals)  # a row for each language, checked
    common = counts.join(totals.select("lang", "total"), "lang").where(F.col("count") >= F.col("total") * least_share)
    lists = common.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct((F.col("count") / F.col("total")).alias("share"), "word")), False).alias("common"))
    classes = F.array(*[F.col(f"c{k}") for k in range(len(CLASSES))])
    shares = F.col("common.share")
    return totals.join(lists, "lang", "left").select(
        F.col("lang").alias("_lang"),
        F.coalesce(F.col("common.word"), F.array().cast("array<string>")).alias("_common"),
        F.coalesce(F.concat(shares, F.array(1 - F.aggregate(shares, F.lit(0.0), lambda a, b: a + b))), F.array(F.lit(1.0))).alias("_shares"),
        _normal(classes).alias("_classes"),
    )


def _normal(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return let(total, lambda t: F.transform(counts, lambda x: F.when(t > 0, x / t).otherwise(0.0)))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance of two distributions of equal length, base 2."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b), F.lit(0.0)))


def quality(docs: DataFrame, references: DataFrame, min_words: int = 50, most_class: float = 0.325, most_word: float = 0.42, lang: str = "lang", text: str = "text") -> DataFrame:
    """Base counts, base_failed, the two distances (null where a guard holds) and kept, for every row."""
    rows = measured(docs, text).withColumns({"n_dup_lines": repeated_lines(F.col("_text")).cast("long"), "n_repeat_words": repeated_words(F.col("_words")).cast("long")})
    rows = rows.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    rows = rows.join(F.broadcast(references), F.col(lang) == F.col("_lang"), "left")  # at most MOST_LANGUAGES rows of at most 100 words
    compared = F.col("_lang").isNotNull() & (F.col("n_words") >= min_words)
    bins = F.array_remove(F.transform("_words", lambda w: F.array_position("_common", w)), 0)
    known = let(bins, lambda b: F.transform("_common", lambda _, k: (F.size(b) - F.size(F.array_remove(b, (k + 1).cast("long")))).cast("double")))
    words = let(known, lambda k: F.concat(k, F.array(F.col("n_words") - F.aggregate(k, F.lit(0.0), lambda a, b: a + b))))
    rows = rows.withColumn("class_distance", F.when(compared, jensen_shannon(_normal(class_counts()), F.col("_classes"))))
    rows = rows.withColumn("word_distance", F.when(compared, jensen_shannon(_normal(words), F.col("_shares"))))
    far = F.coalesce(F.col("class_distance") > most_class, F.lit(False)) | F.coalesce(F.col("word_distance") > most_word, F.lit(False))
    rows = rows.withColumn("kept", ~F.col("base_failed") & ~far)
    return rows.drop("_text", "_rare", "_spaces", "_words", "_lang", "_common", "_shares", "_classes")


def op5_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    references = shared.keep(language_references(docs), "references")
    judged = quality(docs, references)
    distances = [F.round(c, 6).alias(c) for c in ("class_distance", "word_distance")]
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *distances)


_CLASS_SQL = {
    "lower": "length(regexp_replace(t, '[^a-z]+', '', 'g'))",
    "upper": "length(regexp_replace(t, '[^A-Z]+', '', 'g'))",
    "digit": "length(regexp_replace(t, '[^0-9]+', '', 'g'))",
    "space": "length(regexp_replace(t, '[^\\x20\\x09-\\x0D]+', '', 'g'))",
    "symbol": "length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))",
    "wide": "strlen(t) - length(t)",
    "other": "length(t) - c_lower - c_upper - c_digit - c_space - c_symbol",
}
_JS = "CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END / 2 + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END / 2"
#: The query in DuckDB.
ORACLE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
rows AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, {", ".join(f"{v} AS c_{k}" for k, v in _CLASS_SQL.items())} FROM docs),
counted AS (SELECT *, len(words) AS n_words, length(t) - c_space AS word_chars, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
 [{", ".join(f"CAST(c_{k} AS DOUBLE)" for k in CLASSES)}] AS classes FROM rows),
windows AS (SELECT r, unnest(range(1, n_words - {WINDOW - 2})) AS i, words FROM counted WHERE n_words > {WINDOW}),
hashed AS (SELECT r, i, array_to_string(list_slice(words, i, i + {WINDOW - 1}), ' ') AS h FROM windows),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, h) AS n FROM hashed) WHERE n > 1),
covered AS (SELECT r, CAST(sum(least({WINDOW}, i - before)) AS BIGINT) AS n_repeat_words FROM (SELECT r, i, lag(i, 1, i - {WINDOW}) OVER (PARTITION BY r ORDER BY i) AS before FROM twice) GROUP BY r),
spoken AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(words) AS word FROM counted WHERE lang IS NOT NULL) GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS total FROM spoken GROUP BY lang HAVING sum(n) >= 1000),
common AS (SELECT lang, word, n / total AS q FROM spoken JOIN totals USING (lang) WHERE n >= total * 0.01),
base AS (SELECT r, doc_id, n_words, word_chars, c_symbol AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, lang, words, classes
 FROM counted LEFT JOIN covered USING (r)),
compared AS (SELECT base.* FROM base JOIN totals USING (lang) WHERE n_words >= 50),
found AS (SELECT r, word, count(*) AS k FROM (SELECT r, lang, unnest(words) AS word FROM compared) JOIN common USING (lang, word) GROUP BY ALL),
known AS (SELECT compared.r, common.q, coalesce(k, 0) / n_words AS p FROM compared JOIN common USING (lang) LEFT JOIN found ON found.r = compared.r AND found.word = common.word),
filled AS (SELECT r, p, q FROM known UNION ALL SELECT compared.r, 1 - coalesce(sum(p), 0), 1 - coalesce(sum(q), 0) FROM compared LEFT JOIN known USING (r) GROUP BY compared.r),
far_words AS (SELECT r, sqrt(greatest(sum({_JS}), 0)) AS word_distance FROM filled GROUP BY r),
sums AS (SELECT lang, [{", ".join(f"sum(c_{k})" for k in CLASSES)}] AS held FROM counted JOIN totals USING (lang) GROUP BY lang),
pairs AS (SELECT r, unnest(classes) / list_sum(classes) AS p, unnest(held) / list_sum(held) AS q FROM compared JOIN sums USING (lang)),
far_classes AS (SELECT r, sqrt(greatest(sum({_JS}), 0)) AS class_distance FROM pairs GROUP BY r),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base LEFT JOIN far_words USING (r) LEFT JOIN far_classes USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
 base_failed, NOT base_failed AND NOT coalesce(class_distance > 0.325, false) AND NOT coalesce(word_distance > 0.42, false) AS kept, round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance FROM judged
"""
