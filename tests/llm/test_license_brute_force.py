"""The licence scan against a plain version: every cosine, ties by name, nearest ancestors."""

import collections
import math
import random

import pytest
import regex

from quotemill.llm import license_scan

#: `Copy-of-MIT` has a body of MIT, so both always have the same cosine.
TEMPLATES = {k: license_scan.TEMPLATES[k] for k in ("MIT", "GPL-3.0", "CC-BY-4.0", "CC-BY-NC-4.0")} | {"Copy-of-MIT": license_scan.TEMPLATES["MIT"][1:2], "Zed": license_scan.TEMPLATES["CC-BY-4.0"]}
HEADER, NAME, BETWEEN = (regex.compile(x) for x in (license_scan.HEADER, license_scan.FILE_NAME, license_scan.BETWEEN))


def terms(text):
    return [t.rstrip(".-") for t in regex.findall(r"[\p{L}\p{N}][\p{L}\p{N}.-]*", text.lower())]


def words(text):
    return regex.findall(r"[^\x20\x09-\x0D]+", text)


def plain(text):
    return regex.sub(r"\s+", " ", text).strip(" ")


def units(path, text):
    """{(unit, is a licence file, counts in idf, terms of a window)} of one file; no header or paragraph is left out for too few common terms."""
    named = bool(path and NAME.search(path))
    if text is None or not (named or HEADER.search(text)):
        return set()
    runs, run = [], []
    for line in [*text.split("\n"), "-"]:
        if HEADER.search(line):
            run.append(line)
        elif run:
            runs.append(" ".join(run))
            run = []
    is_file = named or 2 * len(words(" ".join(runs))) > len(words(text))
    out = {(plain(x), is_file, True, 0) for x in [*runs, *([text] if named else [])] if plain(x)}
    if not HEADER.search(text):
        return out
    own = terms(text)
    more = [(plain(x), 0) for x in BETWEEN.split(text) if HEADER.search(x)]
    bodies = [terms(b) for v in TEMPLATES.values() for b in v]
    for size in {len(b) for b in bodies}:
        firsts, step = {b[0] for b in bodies if len(b) == size}, max(1, size // 4)
        cut = (" ".join(own[a : a + size]) for a in range(len(own)) if a % step == 0 or own[a] in firsts)
        more += [(x, size) for x in cut if HEADER.search(x)]
    return out | {(x, named or 2 * len(terms(x)) > len(own), False, size) for x, size in more}


def brute(files, threshold):
    of = {f: units(f[1], f[2]) for f in set(files)}
    counted = [terms(u) for found in of.values() for u, _, counts, _ in found if counts]
    df = collections.Counter(t for c in counted for t in set(c))
    weigh = lambda own: {t: n * (math.log((1 + len(counted)) / (1 + df[t])) + 1) for t, n in collections.Counter(own).items()}
    length = lambda x: math.sqrt(sum(v * v for v in x.values()))
    lengths = [len(terms(b)) for v in TEMPLATES.values() for b in v]
    model = [(name, weigh(terms(b))) for name, v in TEMPLATES.items() for b in v]

    def best(unit, size):
        x = weigh(terms(unit))
        # a window is compared where a template of its length has enough of its weight in it
        if size and not any(sum(v * v for t, v in y.items() if t in x) >= (threshold**2 - 1e-9) * length(y) ** 2 for y, n in zip((y for _, y in model), lengths) if n == size):
            return None
        scored = [(-round(sum(v * y[t] for t, v in x.items() if t in y) / (length(x) * length(y)), 12), name) for name, y in model] if x else []
        return min((s for s in scored if -s[0] >= threshold), default=None)

    own, held = {}, {}
    for f, found in of.items():
        scored = [(best(u, size), is_file) for u, is_file, _, size in found]
        scored = [s for s in scored if s[0]]
        if scored:
            own[f] = (min(s[0] for s in scored), any(s[1] for s in scored))
            if own[f][1] and f[1] is not None:
                folder = f[1].rpartition("/")[0]
                held[folder] = min(held.get(folder, own[f][0]), own[f][0])
    out = []
    for f in files:
        if f in own:
            (cosine, name), is_file = own[f]
            out.append((f[0], f[1], name, -cosine, "file" if is_file else "header", None))
            continue
        folder, near = f[1], None
        while folder and near is None:
            folder = folder.rpartition("/")[0]
            near = (folder, held[folder]) if folder in held else None
        out.append((f[0], f[1], near[1][1], -near[1][0], "inherited", near[0]) if near else (f[0], f[1], None, None, None, None))
    return out


def made_files(seed):
    rng = random.Random(seed)
    code = lambda n: " ".join(rng.choice("int main of things and other code without any word on source free".split()) for _ in range(n))
    bodies = [b for v in TEMPLATES.values() for b in v]

    def notice():
        own = rng.choice(bodies).split()
        for _ in range(rng.choice([0, 0, 1, len(own) // 8, len(own) // 3])):
            own[rng.randrange(len(own))] = rng.choice(["other", "licence", "x.y", "the"])
        sep = rng.choice([" ", "\n", " \n * "])
        return "".join(w + (sep if k % 9 == 8 else " ") for k, w in enumerate(own))

    text = {
        0: lambda: code(40),
        1: notice,
        2: lambda: f"{notice()}\n\n{code(60)}",
        3: lambda: f"{code(30)}\n{notice()}\n{code(30)}",
        4: lambda: f"# {code(5)} {notice()} {code(50)}",
        5: lambda: f"{notice()}\n//\n{code(9)}\n\n{notice()}",
        6: lambda: rng.choice(["", " \n ", "Licence", None]),
    }
    files = []
    for k in range(70):
        folder = "/".join(rng.choice("ab") for _ in range(rng.randrange(4)))
        name = rng.choice(["LICENSE", "COPYING", "x.py", "y.py", "z.py", "unlicense.txt", "license_of.py"]) if rng.random() < 0.5 else f"f{k}"
        path = None if k % 17 == 5 else f"{folder}/{name}" if folder else name
        files.append((k, path, text[rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6])]()))
    return [*files, files[3], files[3], (None, "a/b/x", code(12)), (None, None, bodies[0])]


@pytest.mark.parametrize(("seed", "threshold"), [(1, 0.7), (2, 0.45)])
def test_scan_equals_brute_force(spark, seed, threshold):
    files = made_files(seed)
    want = brute(files, threshold)
    df = spark.createDataFrame(files, "doc_id long, path string, text string").repartition(5)
    done = license_scan.scan(df, templates=TEMPLATES, threshold=threshold).collect()
    key = lambda r: tuple((v is None, v) for v in (r[0], r[1], r[2], r[4], r[5]))
    assert sorted(map(key, done)) == sorted(map(key, want))
    for a, b in zip(sorted(done, key=key), sorted(want, key=key)):
        assert a[3] == b[3] or abs(a[3] - b[3]) < 1e-9
    names = collections.Counter(r[2] for r in want)
    # equal cosines go to the first name: never to the copies that come later in it
    assert names["Copy-of-MIT"] and names["CC-BY-4.0"] and not names["Zed"]
    assert {r[4] for r in want} == {"file", "header", "inherited", None}
