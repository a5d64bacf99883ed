"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=None, seed=5):
    if rows is None:
        rows = corpus(seed)
    return spark.createDataFrame(rows, SCHEMA)


def corpus(seed=5, n=60):
    rng = random.Random(seed)
    vocabulary = {"en": "the of and to in is it that was for with on as at by".split() + [f"w{k}th" for k in range(300)], "de": "der die und das ist nicht ein zu mit auf".split() + [f"z{k}sch" for k in range(300)]}
    rows = []
    for k in range(n):
        lang = "en" if k % 3 else "de"
        words = [rng.choice(vocabulary[lang][:12]) if rng.random() < 0.4 else rng.choice(vocabulary[lang]) for _ in range(rng.choice([3, 25, 60, 200]))]
        rows.append((k, " ".join(words), lang, f"src{k % 3}", 1))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "src0", 0), (n + 2, " \n\t", None, None, 3), (n + 3, "x" * 5000, "en", "src1", 5000), (None, "a b c", "en", "src1", 5)]
    rows += [rows[1], rows[1], (n + 4, rows[3][1], "en", "src2", 1), (n + 5, " ".join(["long words in a row"] * 3000), "en", "src0", 1)]
    return rows
