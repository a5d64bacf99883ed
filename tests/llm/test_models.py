import collections
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quotemill.llm import decontaminate, divergence, jaccard_join, language_id, license_scan, ngram_model

from .data import SCHEMA, corpus, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def kneser_ney(train):
    """Brute-force bigram model: a function of (context, word)."""
    pairs = collections.Counter()
    for words in train:
        pairs.update(zip(["<s>", *words], [*words, "</s>"]))
    contexts, kinds = collections.Counter(), collections.Counter()
    for (v, w), c in pairs.items():
        contexts[v] += c
        kinds[w] += 1

    def discounts(values):
        n = [sum(1 for v in values if v == k) for k in (1, 2, 3, 4)]
        if min(n) == 0:
            return (0, 0.5, 1.0, 1.5)
        y = n[0] / (n[0] + 2 * n[1])
        found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
        return (0, *found) if all(0 < d <= k for k, d in enumerate(found, 1)) else (0, 0.5, 1.0, 1.5)

    high, low, size = discounts(pairs.values()), discounts(kinds.values()), len(kinds)
    rest = sum(low[min(c, 3)] for c in kinds.values()) / len(pairs) / (size + 1)
    single = lambda w: max(kinds[w] - low[min(kinds[w], 3)], 0) / len(pairs) + rest
    given = collections.Counter()
    for (v, _), c in pairs.items():
        given[v] += high[min(c, 3)]
    return lambda v, w: max(pairs[v, w] - high[min(pairs[v, w], 3)], 0) / contexts[v] + given[v] / contexts[v] * single(w) if contexts[v] else single(w)


def test_ngram_model(spark):
    rows = corpus()
    docs = documents(spark, rows)
    fold = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    train = [WORD.findall(lower(r[1])) for r in rows if not fold(r[0])]
    p = kneser_ney(train)
    counts = collections.Counter(w for t in train for w in [*t, "</s>"])
    total, size = sum(counts.values()), len(counts)
    model = ngram_model.train(docs.where(~ngram_model.held_out("doc_id")))
    assert (model.n_tokens, model.vocabulary) == (total, size)
    got = collections.defaultdict(list)
    for r in ngram_model.score(docs, model).collect():
        got[r.doc_id].append(r)
    for i, text, *_ in rows:
        words = [*WORD.findall(lower(text)), "</s>"]
        r = got[i].pop()
        assert (r.n_tokens, r.n_known) == (len(words), sum(w in counts for w in words))
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (size + 1))) for w in words))
        assert r.score == pytest.approx(sum(math.log10(p(v, w)) for v, w in zip(["<s>", *words], words)))
    for v in ["<s>", "the", "w1th"]:  # a distribution over known words and the unknown one
        assert sum(p(v, w) for w in [*counts, "???"]) == pytest.approx(1)
    empty = ngram_model.train(docs.limit(0))
    assert {r.score for r in ngram_model.score(docs, empty).collect()} == {0.0}


def test_jaccard_join_equals_brute_force(spark):
    rng = random.Random(3)
    rows = corpus(n=30)
    base = [f"t{k}" for k in range(200)]
    boiler = [f"common{k}" for k in range(40)]
    texts = [" ".join(base)]
    for k in range(30):  # near copies with few or many edits, chains, shared passages
        words = texts[rng.randrange(len(texts))].split()
        for _ in range(rng.choice([1, 2, 5, 12])):
            words[rng.randrange(len(words))] = f"e{rng.random()}"
        texts.append(" ".join(words))
    texts += [" ".join([*[f"r{k}-{j}" for j in range(rng.choice([5, 12, 60]))], *boiler]) for k in range(25)] + ["a b c", "A B C", "a b", " ".join(boiler)] * 2
    rows += [(1000 - k, t, "en", "s", 1) for k, t in enumerate(texts)]
    found = jaccard_join.near_duplicates(documents(spark, rows), links=True).collect()
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in found}
    sets = []
    for r in rows:
        w = WORD.findall(lower(r[1]))
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    root, n_links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                root[find(x)] = find(y)
                n_links[x] += 1
                n_links[y] += 1
    least = {}
    for x, r in enumerate(rows):
        if r[0] is not None:
            least[find(x)] = min(least.get(find(x), r[0]), r[0])
    assert got == {(r[0], len(sets[x]), least.get(find(x))) for x, r in enumerate(rows)}
    assert sorted((str(r.doc_id), r.n_links) for r in found) == sorted((str(r[0]), n_links[x]) for x, r in enumerate(rows))
    assert jaccard_join.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_divergence(spark):
    junk = "$$$ ### " * 60
    extra = [(500, junk, "en", "s", 1), (501, "x y\n" * 3 + "x y\n \n", "en", "s", 1), (502, " ".join(f"u{k}" for k in range(30)) + " a b c d e f g h 1 a b c d e f g h i", None, "s", 1), (503, "é Ü😀 " * 40, "en", "s", 1)]
    rows = corpus() + extra
    docs = documents(spark, rows)
    got = divergence.quality(docs, divergence.language_references(docs)).collect()
    assert len(got) == len(rows)
    seen = collections.defaultdict(list)
    for r in got:
        seen[r.doc_id].append(r)
    for i, text, *_ in rows:
        text, r = text or "", seen[i].pop()
        words = WORD.findall(text)
        windows = collections.Counter(tuple(words[j : j + 8]) for j in range(len(words) - 7))
        cover = {j + k for j in range(len(words) - 7) if windows[tuple(words[j : j + 8])] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(cover)), i
        assert r.base_failed == (len(words) < 20 or 100 * len(cover) > 30 * len(words)) and not (r.base_failed and r.kept)
    by_id = {r.doc_id: r for r in got}
    assert not by_id[500].kept and by_id[502].class_distance is None
    alike = divergence.quality(docs, divergence.language_references(docs.where("doc_id < 60"))).where("doc_id < 60 and n_words > 50")
    assert alike.where("not kept").count() == 0
    assert divergence.quality(docs.limit(0), divergence.language_references(docs.limit(0))).count() == 0


def test_language_id(spark):
    rows = corpus(n=200)
    docs = documents(spark, rows)
    model = language_id.train(docs.where(~language_id.in_fold("doc_id")))
    found = language_id.identify(docs, model).select("doc_id", "text", "lang", "lang_pred", "score").collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.lang and r.text and any(c.isalpha() for c in r.text) and len(r.text.split()) > 5]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert {r.lang_pred for r in found if not any(c.isalpha() for c in r.text or "")} == {"und"}
    nothing = language_id.train(docs.where("lang = 'xx'"))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_leaks(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(k, text(rng.choice([14, 30, 55])).capitalize() + ".") for k in range(40)] + [(50, None), (51, ""), (52, "What is the tallest kind of tree found on this coast, asked the child? Answer: giant redwood")]
    docs, leaks = [], set()
    for k in range(80):
        body = text(300).split()
        if k % 2:
            item = k // 2
            leak = items[item][1].upper().split()
            if k % 4 == 1 and len(leak) > 20:
                del leak[3::9]  # a paraphrase with words missing
            body[100:100] = leak
            leaks.add((k, item))
        docs.append((k, " ".join(body), "en", "s", 1))
    docs += [(200, None, None, None, 0), (201, "", "en", "s", 0), (202, "Of what kind is the tallest tree on this coast: giant redwood", "en", "s", 1)]
    got = decontaminate.find_leaks(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), block=25).collect()
    assert {(r.doc_id, r.item_id) for r in got} - {(202, 52)} == leaks
    none = decontaminate.find_leaks(documents(spark, docs), spark.createDataFrame([], "item_id long, text string"))
    assert none.count() == 0 and decontaminate.find_leaks(documents(spark, docs).limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_lcs():
    import numpy as np

    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.lcs_length(np.array(a), np.array(b)) == table[-1][-1]


def test_licences(spark):
    files = [
        (1, "a/LICENSE", license_scan.TEMPLATES["MIT"][1]),
        (2, "a/src/x.py", "# SPDX-License-Identifier: Apache-2.0\n" + "code and more code " * 9),
        (3, "a/src/deep/y.py", "just code here"),
        (4, "b/z.py", "code"),
        (5, "a/vendor/COPYING", license_scan.TEMPLATES["GPL-3.0"][1]),
        (6, "a/vendor/lib/w.c", "int main"),
        (7, None, None),
        (8, "a/empty", ""),
        (9, "a/doc.txt", "some words about things\nLicensed under CC BY-NC 4.0.\n" + "more words " * 50),
        (9, "a/doc.txt", "some words about things\nLicensed under CC BY-NC 4.0.\n" + "more words " * 50),
        (10, "a/talk", "The licensing board met on monday to speak of many other matters entirely " * 4),
    ]
    df = spark.createDataFrame([(*f, "x") for f in files], "doc_id long, path string, text string, licence string")
    got = {r.doc_id: (r.licence, r.found, r.from_dir) for r in license_scan.scan(df).collect()}
    assert got[1][:2] == ("MIT", "file") and got[2][:2] == ("Apache-2.0", "header")
    assert got[3] == ("MIT", "inherited", "a") and got[4] == (None, None, None) and got[6] == ("GPL-3.0", "inherited", "a/vendor")
    assert got[7] == (None, None, None) and got[8] == ("MIT", "inherited", "a") and got[9][:2] == ("CC-BY-NC-4.0", "header") and got[10][1] == "inherited"
    assert license_scan.scan(df).count() == len(files) and license_scan.scan(df.limit(0)).count() == 0


def test_leaks_of_long_items(spark):
    import numpy as np

    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(6000)]
    words = lambda n: rng.sample(vocabulary[:5900], n) if n > 10 else rng.sample(vocabulary[5900:], n)
    items = [(k, words(n)) for k, n in enumerate([1, 3, 7, 16, 20, 26, 40, 60, 75, 91, 200, 400, 800, 1200, 1500, 2000])]
    docs = []
    for k, item in items:
        for share in (1, 0.75, 0.6) if len(item) > 10 else (1,):
            for drop in (False, True):
                copy = [w if rng.random() < share else None if drop else rng.choice(vocabulary[:5900]) for w in item]
                docs.append([*words(rng.randint(60, 200)), *[w for w in copy if w], *words(90)])
    docs += [words(1500) for _ in range(4)]  # without a passage
    head = [*words(40), *items[-1][1][1900:1970], *words(300), *items[-1][1], *words(50)]  # a fragment some way before the whole
    docs.append(head)
    code = {w: i for i, w in enumerate(vocabulary)}
    ints = lambda x: np.array([code[w] for w in x])
    want = set()
    for d, doc in enumerate(docs):
        for k, item in items:
            answer = item[len(item) - max(1, len(item) // 5) :]
            lcs = decontaminate.lcs_length(ints(item), ints(doc)) / len(item)
            if lcs >= 0.7 or lcs >= 0.5 and decontaminate.lcs_length(ints(answer), ints(doc)) >= 0.8 * len(answer):
                want.add((d, k))
    rows = [(d, " ".join(doc), "en", "s", 1) for d, doc in enumerate(docs)]
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in items], "item_id long, text string")
    found = decontaminate.find_leaks(documents(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert {r.lcs for r in found if (r.doc_id, r.item_id) == (len(docs) - 1, len(items) - 1)} == {1.0}
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(documents(spark, rows), benchmark, block=100).collect()} == want


def test_licences_across_lines(spark):
    import textwrap

    wrap = lambda text, mark: "\n".join(mark + x for x in textwrap.wrap(text, 70))
    T, code = license_scan.TEMPLATES, "\nint main of things and other code without a word on it\n" * 30
    apache = T["Apache-2.0"][1].replace("You may obtain", "\n\nYou may obtain").replace("Unless", "\n\nUnless")
    long_line = " ".join(f"word{k}" for k in range(300))
    files = [
        (1, "src/en/1", wrap(T["MIT"][1], " * ") + code, "MIT", "header"),
        (2, "src/en/2", "# Copyright 2020 Some Body\n#\n" + "\n#\n".join(wrap(x, "# ") for x in apache.split("\n\n")) + code, "Apache-2.0", "header"),
        (3, "src/en/3", code + wrap(T["BSD-3-Clause"][0], "// ") + code, "BSD-3-Clause", "header"),
        (4, "src/en/4", f"{long_line} {T['GPL-3.0'][1]} {long_line}", "GPL-3.0", "header"),
        (5, "src/en/5", f"{long_line} {T['CC-BY-4.0'][0]} {long_line}", "CC-BY-4.0", "header"),
        (6, "full/LICENSE", "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + wrap(T["MIT"][2], ""), "MIT", "file"),
        (7, "full/x.c", "code", "MIT", "inherited"),
        (8, "src/de/8", "MIT License\n\nCopyright (c) 2021 Else\n\n" + wrap(T["MIT"][2], ""), "MIT", "file"),
        (9, "src/xx/9", f"{long_line} the board for licensing met to speak of the source of free things {long_line}", None, None),
        (10, "bsd/COPYING", "Copyright (c) 2020\n\n" + wrap(T["BSD-3-Clause"][1], ""), "BSD-3-Clause", "file"),
    ]
    df = spark.createDataFrame([f[:3] for f in files], "doc_id long, path string, text string")
    got = {r.doc_id: (r.licence, r.found) for r in license_scan.scan(df).collect()}
    assert got == {f[0]: f[3:] for f in files}


def test_language_features_equal_brute_force(spark):
    def grams(text):
        stream = " " + re.sub(r"[^a-zäöüßéè]+", " ", text.lower()).lstrip() + " "
        out = collections.Counter()
        for n in (1, 2, 3):
            for k in range(len(stream) - n + 1):
                h = n
                for c in stream[k : k + n]:
                    h = ((h ^ ord(c)) * 0x9E3779B1) & 0xFFFFFFFF
                    h ^= h >> 15
                out[h >> (32 - language_id.BITS)] += 1
        return dict(out)

    rng = random.Random(1)
    for length in (1, 2, 7, 40, 900):
        text = "".join(rng.choice("aBcß é,. 1\n") for _ in range(length)) + "z"
        for piece in (1, 2, 3, 10, 1 << 20):  # the cuts between pieces leave no trace
            at, counts = language_id.features(text, piece)
            assert dict(zip(at.tolist(), counts.tolist())) == grams(text)
    assert not len(language_id.features("1 ,2\n")[0]) and not len(language_id.features(None)[0])

    rows = corpus(n=40)
    docs = documents(spark, rows)
    model = language_id.train(docs)
    frequency = collections.Counter()
    labelled = [r for r in rows if r[2] is not None]
    for r in labelled:
        frequency.update(grams(r[1] or "").keys() if re.search("[a-z]", r[1] or "", re.I) else ())
    for k, n in frequency.items():
        assert model.idf[k] == pytest.approx(math.log((1 + len(labelled)) / (1 + n)) + 1, rel=1e-5)
    text = rows[1][1]
    x = {k: math.log1p(c) * float(model.idf[k]) for k, c in grams(text).items()}
    norm = math.sqrt(sum(v * v for v in x.values()))
    logits = [sum(v / norm * float(model.weights[k, j]) for k, v in x.items()) / model.temperature for j in range(len(model.languages))]
    soft = [math.exp(v) / sum(math.exp(u) for u in logits) for v in logits]
    lang, score = model.predict(text)
    assert lang == model.languages[soft.index(max(soft))] and score == pytest.approx(max(soft), rel=1e-4)


def test_ftrl_equals_brute_force():
    import numpy as np

    rng = np.random.default_rng(5)
    rows = [(np.sort(rng.choice(50, 6, replace=False)), rng.random(6).astype(np.float32)) for _ in range(30)]
    labels = np.array([int(r[0][0]) % 3 for r in rows])
    got = language_id.fit_ftrl(rows, labels, 3, epochs=2)
    z, n = collections.defaultdict(float), collections.defaultdict(float)
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.1
    weight = lambda k: 0.0 if abs(z[k]) <= l1 else (math.copysign(l1, z[k]) - z[k]) / ((beta + math.sqrt(n[k])) / alpha + l2)
    order = np.random.default_rng(7)
    for _ in range(2):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            logits = [sum(float(v) * weight((a, j)) for a, v in zip(at.tolist(), x)) for j in range(3)]
            total = sum(math.exp(v) for v in logits)
            for a, v in zip(at.tolist(), x):
                for j in range(3):
                    g = float(v) * (math.exp(logits[j]) / total - (labels[i] == j))
                    w = weight((a, j))
                    z[a, j] += g - (math.sqrt(n[a, j] + g * g) - math.sqrt(n[a, j])) / alpha * w
                    n[a, j] += g * g
    for a in range(50):
        for j in range(3):
            assert got[a, j] == pytest.approx(weight((a, j)), abs=1e-3)


def test_languages_are_bounded(spark):
    many = spark.range(language_id.MAX_LANGUAGES + 1).select(F.lit("some words").alias("text"), F.concat(F.lit("l"), "id").alias("lang"))
    with pytest.raises(ValueError):
        language_id.train(many)
    copies = spark.range(3000).select(F.lit("the same text").alias("text"), F.lit("en").alias("lang")).unionByName(spark.range(50).select(F.concat(F.lit("ein anderer Satz "), "id").alias("text"), F.lit("de").alias("lang")))
    model = language_id.train(copies, sample=20)
    assert model.predict("the same text")[0] == "en" and model.predict("ein anderer Satz")[0] == "de"
