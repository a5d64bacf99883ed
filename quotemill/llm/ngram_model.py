"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

The vocabulary is a sorted array of 64-bit word hashes, cut into shards by hash; a
word's id is its rank. Bigrams are sorted arrays of id pairs with their counts. A shard
takes an equal share of the tokens: a pair's place is its context's place among all
tokens plus the word's place within the context, so a frequent context spreads over
many shards. Both are files of the shared folder that workers memory-map.

    p(w | v) = max(c(v, w) - D(c(v, w)), 0) / c(v .) + g(v) p(w)
    p(w) = max(N1+(. w) - D', 0) / N1+(. .) + g' / (V + 1)

D and D' are the three discounts of counts 1, 2 and 3 or more; g and g' give away what
they take. A word outside the vocabulary has g' / (V + 1); after an unseen context the
probability is p(w). Every text ends with one end token and starts in the start context.
A null or empty text is its end token. Without training rows each token has
probability 1. Ids are 32-bit: a vocabulary of over 4 thousand million words is refused;
counts are 64-bit. Texts are scored whole, however long; repeated rows count and score
like any; only the id and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays, shared
from .textcore import map_texts, sorted_counts, word_hashes

END = np.int64(0x5E0FED0C5E0FED0C)
#: Tokens of a shard of bigrams, and words of a shard of the vocabulary (and of its statistics).
SHARD_TOKENS, SHARD_WORDS = 4_000_000, 2_000_000


def held_out(doc_id: str, fold: int = 10, remainder: int = 0) -> Column:
    """crc32 of the id as text, modulo `fold`, is `remainder`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % fold == remainder


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with END after each row's words, and the number of tokens of each row."""
    data, offsets = map_texts(batch)
    words, counts = word_hashes(data, offsets)
    sizes = counts + 1
    out = np.full(sizes.sum(), END, np.int64)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(sizes) - 1] = False
    out[inner] = words.view(np.int64)
    return out, sizes


@dataclass
class Model:
    """Where the arrays lie, and the constants."""

    path: str
    n_tokens: int = 0
    n_docs: int = 0
    bases: list[int] = field(default_factory=list)
    firsts: list[int] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)
    vocabulary: int = 0
    n_shards: int = 1
    pairs: frozenset = frozenset()
    discounts: tuple[float, ...] = (0.5, 1.0, 1.5)
    unseen: float = 1.0
    finished: bool = False
    _open: dict = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def arrays_of(self, name: str, *dtypes) -> list[np.ndarray]:
        if name not in self._open:
            self._open[name] = arrays.map_arrays(f"{self.path}/{name}", *dtypes)
        return self._open[name]

    def look_up(self, hashes: np.ndarray) -> dict[str, np.ndarray]:
        """For each hash: id (-1 if unknown), count, tokens before it, and once finished p, g and the context's count."""
        order = np.argsort(hashes)
        ordered = hashes[order]
        first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        asked = ordered[first]
        out = {"id": np.full(len(asked), -1, np.int64), "count": np.zeros(len(asked), np.int64), "before": np.zeros(len(asked), np.int64)}
        if self.finished:
            out |= {"p": np.full(len(asked), self.unseen), "g": np.ones(len(asked)), "context": np.zeros(len(asked), np.int64)}
        edges = np.concatenate(([0], np.searchsorted(asked, np.array(self.firsts[1:], np.int64)), [len(asked)])) if self.bases else [0]
        for s in range(len(self.bases)):
            part = slice(edges[s], edges[s + 1])
            if part.stop <= part.start:
                continue
            words, counts, before = self.arrays_of(f"words-{s:06d}", np.int64, np.int64, np.int64)
            at = np.minimum(np.searchsorted(words, asked[part]), len(words) - 1)
            hit = words[at] == asked[part]
            out["id"][part] = np.where(hit, at + self.bases[s], -1)
            out["count"][part] = np.where(hit, counts[at], 0)
            out["before"][part] = np.where(hit, before[at] + self.starts[s], 0)
            if self.finished:
                p, g, context = self.arrays_of(f"stats-{s:06d}", np.float64, np.float64, np.int64)
                out["p"][part] = np.where(hit, p[at], self.unseen)
                out["g"][part] = np.where(hit, g[at], 1.0)
                out["context"][part] = np.where(hit, context[at], 0)
        back = np.empty(len(hashes), np.int64)
        back[order] = np.cumsum(first) - 1
        return {k: v[back] for k, v in out.items()}

    def pairs_of(self, sizes: np.ndarray, found: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys and shards of the bigrams of a batch, where both sides are known, and which tokens start a row."""
        starts = np.cumsum(sizes) - sizes
        w, v = found["id"], np.empty(len(found["id"]), np.int64)
        before, count = np.empty(len(v), np.int64), np.empty(len(v), np.int64)
        v[1:], before[1:], count[1:] = w[:-1], found["before"][:-1], found["count"][:-1]
        v[starts], before[starts], count[starts] = self.vocabulary, self.n_tokens, self.n_docs
        known = (w >= 0) & (v >= 0)
        place = before + count * (found["before"] / max(1, self.n_tokens))
        shard = np.minimum((place * (self.n_shards / max(1, self.n_tokens + self.n_docs))).astype(np.int64), self.n_shards - 1)
        return (v.astype(np.uint64) << np.uint64(32)) | w.astype(np.uint64), shard, known, starts


def _discounts(n: np.ndarray) -> tuple[float, float, float]:
    """Of counts 1, 2 and 3 or more, from how many types have count 1 to 4; fixed ones where these give none in range."""
    if min(n[:4]) <= 0:
        return (0.5, 1.0, 1.5)
    y = n[0] / (n[0] + 2 * n[1])
    found = tuple(float(k - (k + 1) * y * n[k] / n[k - 1]) for k in (1, 2, 3))
    return found if all(0 < d <= k for k, d in enumerate(found, 1)) else (0.5, 1.0, 1.5)


def _count_words(docs: DataFrame) -> DataFrame:
    def count(batches):
        held, size = [], 0

        def out():
            words, counts = sorted_counts(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts)], names=["word", "n"])

        for batch in batches:
            for part in arrays.slices(batch):
                tokens, _ = _tokens(part)
                held.append(tokens)
                size += len(tokens)
                if size >= arrays.FLUSH:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _write_vocabulary(counts: DataFrame, path: str) -> list:
    def write(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            shard, table = TaskContext.get().partitionId(), pa.Table.from_batches(batches)
            words, n = table.column(0).to_numpy(), table.column(1).to_numpy()
            arrays.write_arrays(path, f"part-of-words-{shard:06d}", words, n, np.cumsum(n) - n)
            yield pa.RecordBatch.from_pydict({"shard": [shard], "words": [len(words)], "tokens": [int(n.sum())], "first": [int(words[0])]})

    parts = max(shared.partitions(counts.sparkSession), counts.count() // SHARD_WORDS)
    dealt = counts.repartitionByRange(parts, "word").sortWithinPartitions("word")
    return sorted(shared.keep(dealt.mapInArrow(write, "shard long, words long, tokens long, first long"), "vocabulary").collect())  # a row for each file


def _count_pairs(docs: DataFrame, model: Model) -> DataFrame:
    def count(batches):
        held, size = [], 0

        def out():
            keys, shards = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(keys)
            keys, shards = keys[order], shards[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            return arrays.blob_batch(list(arrays.shard_blobs(keys[first], np.diff(np.append(first, len(keys))), shards[first])))

        for batch in batches:
            for part in arrays.slices(batch):
                tokens, sizes = _tokens(part)
                keys, shards, _, _ = model.pairs_of(sizes, model.look_up(tokens))
                held.append((keys, shards))
                size += len(keys)
                if size >= arrays.FLUSH:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    return docs.select("text").mapInArrow(count, arrays.BLOBS)


STATS = "kind string, part int, ids binary, totals binary, ones binary, twos binary, more binary, types array<long>"


def _merge_pairs(blobs: DataFrame, model: Model) -> DataFrame:
    """Write each shard's pairs; give, by vocabulary shard, the contexts' totals and the words' numbers of contexts."""

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, counts = arrays.merge_blobs(table)
        arrays.write_arrays(model.path, f"pairs-{shard:06d}", keys, counts.astype(np.int64))
        rows = [("shard", shard, b"", b"", b"", b"", b"", [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [len(keys)])]
        v, w = keys >> np.uint64(32), np.sort(keys & np.uint64(0xFFFFFFFF))
        first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
        sums = [np.add.reduceat(x.astype(np.int64), first).astype(np.uint64) for x in (counts, counts == 1, counts == 2, counts > 2)]
        rows += _by_part(model.bases, "context", v[first], sums)
        ids, n = sorted_counts(w)
        rows += _by_part(model.bases, "word", ids, [n.astype(np.uint64)])
        return _stats_table(rows)

    return blobs.groupBy("shard").applyInArrow(merge, STATS)


def _by_part(bases: list[int], kind: str, ids: np.ndarray, values: list[np.ndarray]) -> list[tuple]:
    part = np.searchsorted(np.array(bases, np.uint64), ids, "right") - 1
    edges = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(ids)]))
    blank = [b""] * (4 - len(values))
    return [(kind, int(part[a]), arrays.pack(ids[a:b]), *[arrays.pack(x[a:b]) for x in values], *blank, []) for a, b in zip(edges[:-1], edges[1:]) if b > a]


def _stats_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.string(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.int64())]
    names = ["kind", "part", "ids", "totals", "ones", "twos", "more", "types"]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)


def _sum_part(table: pa.Table, base: int, size: int) -> dict[str, np.ndarray]:
    """Dense sums over a part's ids (and, in the last part, the start context behind them)."""
    out = {k: np.zeros(size + 1, np.int64) for k in ("total", "one", "two", "more", "contexts")}
    for row in table.to_pylist():
        ids = (arrays.unpack(row["ids"], np.uint64).astype(np.int64) - base).clip(0, size)
        if row["kind"] == "word":
            out["contexts"][ids] += arrays.unpack(row["totals"], np.uint64).astype(np.int64)
        else:
            for k, c in (("total", "totals"), ("one", "ones"), ("two", "twos"), ("more", "more")):
                out[k][ids] += arrays.unpack(row[c], np.uint64).astype(np.int64)
    return out


def train(docs: DataFrame) -> Model:
    """Count and store the model of column `text`."""
    spark = docs.sparkSession
    model = Model(shared.new_path(spark, "ngrams"))
    rows = _write_vocabulary(shared.keep(_count_words(docs), "word-counts"), model.path)
    if not rows:
        model.finished = True
        return model
    names = [f"part-of-words-{r['shard']:06d}" for r in rows]
    model.bases = list(accumulate((r["words"] for r in rows[:-1]), initial=0))
    model.starts = list(accumulate((r["tokens"] for r in rows[:-1]), initial=0))
    model.firsts = [r["first"] for r in rows]
    model.vocabulary, model.n_tokens = sum(r["words"] for r in rows), sum(r["tokens"] for r in rows)
    if model.vocabulary >= 1 << 32:
        raise ValueError("the vocabulary has over 2**32 words")
    fs, root = shared.open_fs(model.path)
    for k, name in enumerate(names):
        fs.move(f"{root}/{name}", f"{root}/words-{k:06d}")
    model.n_docs = docs.count()
    model.n_shards = max(shared.partitions(spark), model.n_tokens // SHARD_TOKENS)

    stats = shared.keep(_merge_pairs(_count_pairs(docs, model), model), "pair-stats")
    shards = stats.where("kind = 'shard'").select("part", *[F.col("types")[k].alias(f"n{k}") for k in range(5)])
    made = [r[0] for r in shards.select("part").collect()]  # a row for each file
    totals = shards.agg(*[F.sum(f"n{k}") for k in range(5)]).first()
    model.pairs, model.discounts = frozenset(made), _discounts(np.array(totals[:4], float))
    sizes = [b - a for a, b in zip(model.bases, [*model.bases[1:], model.vocabulary])]
    bases, path = model.bases, model.path
    parts = stats.where("kind <> 'shard'")

    def types(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        n = _sum_part(table, bases[part], sizes[part])["contexts"]
        return pa.table({f"n{k}": pa.array([int(v)], pa.int64()) for k, v in enumerate([(n == 1).sum(), (n == 2).sum(), (n == 3).sum(), (n == 4).sum(), (n > 2).sum(), n.sum()])})

    kinds = parts.where("kind = 'word'").groupBy("part").applyInArrow(types, ", ".join(f"n{k} long" for k in range(6)))
    n = np.array(kinds.agg(*[F.sum(f"n{k}") for k in range(6)]).first(), float)
    low = _discounts(n[:4])
    model.unseen = float((low[0] * n[0] + low[1] * n[1] + low[2] * n[4]) / n[5] / (model.vocabulary + 1))
    high, unseen, last, n_words = model.discounts, model.unseen, len(bases) - 1, float(n[5])

    def finish(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        x = _sum_part(table, bases[part], sizes[part])
        p = np.maximum(x["contexts"] - np.array((0, *low))[np.minimum(x["contexts"], 3)], 0) / n_words + unseen
        g = (high[0] * x["one"] + high[1] * x["two"] + high[2] * x["more"]) / np.maximum(x["total"], 1)
        g = np.where(x["total"] > 0, g, 1.0)
        end = sizes[part]
        arrays.write_arrays(path, f"stats-{part:06d}", p[:end], g[:end], x["total"][:end])
        if part == last:
            arrays.write_arrays(path, "start", p[end:], g[end:], x["total"][end:])
        return pa.table({"part": pa.array([part], pa.int32())})

    shared.keep(parts.groupBy("part").applyInArrow(finish, "part int"), "finished")
    model.finished = True
    return model


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score (add-0.1 unigrams) and score (log10 probability by the model)."""
    base_of = np.log10(model.n_tokens + 0.1 * (model.vocabulary + 1))

    def rows(batches):
        for batch in batches:
            for part in arrays.slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, _score(model, part, base_of))], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return docs.select(F.col(doc_id).alias("doc_id"), "text").mapInArrow(rows, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def _score(model: Model, part: pa.RecordBatch, base_of: float) -> tuple[np.ndarray, ...]:
    tokens, sizes = _tokens(part)
    found = model.look_up(tokens)
    keys, shards, known, starts = model.pairs_of(sizes, found)
    context, g = np.empty(len(keys), np.int64), np.empty(len(keys))
    context[1:], g[1:] = found["context"][:-1], found["g"][:-1]
    context[starts], g[starts] = 0, 1.0
    if model.n_tokens:
        _, g_start, c_start = model.arrays_of("start", np.float64, np.float64, np.int64)
        context[starts], g[starts] = c_start[0], g_start[0]
    at = np.flatnonzero(known)
    order = at[np.argsort(keys[at])]
    asked, of = keys[order], shards[order]
    counts = np.zeros(len(keys), np.int64)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(of)) + 1, [len(of)])) if len(of) else np.zeros(1, int)
    for a, b in zip(edges[:-1], edges[1:]):
        if of[a] in model.pairs:
            pairs, n = model.arrays_of(f"pairs-{of[a]:06d}", np.uint64, np.int64)
            i = np.minimum(np.searchsorted(pairs, asked[a:b]), len(pairs) - 1)
            counts[order[a:b]] = np.where(pairs[i] == asked[a:b], n[i], 0)
    taken = np.maximum(counts - np.array((0, *model.discounts))[np.minimum(counts, 3)], 0)
    p = np.where(context > 0, taken / np.maximum(context, 1) + g * found["p"], found["p"])
    base = np.log10(found["count"] + 0.1) - base_of
    sums = lambda x: np.add.reduceat(x, starts) if len(starts) else x
    return sizes, sums((found["id"] >= 0).astype(np.int64)), sums(base), sums(np.log10(p))


def op1_ngram_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document by a model of those that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs.where(~held_out("doc_id")))
    scored = score(docs, model).withColumn("held_out", held_out("doc_id")).withColumn("train_tokens", F.lit(model.n_tokens).cast("long"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", *[F.round(c, 6).alias(c) for c in ("base_score", "score")])


def _discount_sql(table: str, column: str) -> str:
    """The three discounts as a list, by the rule of `_discounts`."""
    n = [f"count(*) FILTER ({column} = {k})" for k in (1, 2, 3, 4)]
    y = "(n1 / (n1 + 2 * n2))"
    found = [f"{k} - {k + 1} * {y} * n{k + 1} / n{k}" for k in (1, 2, 3)]
    fits = " AND ".join(f"d[{k}] > 0 AND d[{k}] <= {k}" for k in (1, 2, 3))
    raw = f"SELECT CASE WHEN least(n1, n2, n3, n4) > 0 THEN [{', '.join(found)}] END AS d FROM (SELECT {', '.join(f'{x} AS n{k}' for k, x in enumerate(n, 1))} FROM {table})"
    return f"SELECT CASE WHEN d IS NOT NULL AND {fits} THEN d ELSE [0.5, 1.0, 1.5] END AS d FROM ({raw})"


#: The query in DuckDB. CRC-32 runs over a table of 256 values that the SQL itself makes; ' s' and ' e' are start and end.
ORACLE_SQL = f"""
WITH crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) AS v FROM range(256) AS r(i))),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS name, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
summed AS (SELECT docs.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), CASE WHEN name = '' THEN [] ELSE list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT)) END), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 10 = 0 AS held_out FROM docs, crc),
tokens AS (SELECT r, held_out, unnest(list_prepend(' s', words)) AS v, unnest(list_append(words, ' e')) AS w FROM summed),
words AS (SELECT w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY w),
total AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS size FROM words),
pairs AS (SELECT v, w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY v, w),
kinds AS (SELECT w, count(*) AS k FROM pairs GROUP BY w),
high AS ({_discount_sql("pairs", "c")}),
low AS ({_discount_sql("kinds", "k")}),
n_pairs AS (SELECT count(*) AS m FROM pairs),
rest AS (SELECT sum(low.d[least(k, 3)]) / max(m) / (count(*) + 1) AS p FROM kinds, low, n_pairs),
single AS (SELECT w, greatest(k - low.d[least(k, 3)], 0) / m + rest.p AS p FROM kinds, low, n_pairs, rest),
contexts AS (SELECT v, sum(c) AS c, sum(high.d[least(c, 3)]) AS given FROM pairs, high GROUP BY v),
scored AS (SELECT r, words.c, coalesce(single.p, rest.p) AS p1, contexts.c AS cv, given, greatest(coalesce(pairs.c, 0) - coalesce(high.d[least(pairs.c, 3)], 0), 0) AS taken
 FROM tokens LEFT JOIN words USING (w) LEFT JOIN single USING (w) LEFT JOIN contexts USING (v) LEFT JOIN pairs USING (v, w), rest, high)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, CAST(max(n) AS BIGINT) AS train_tokens, round(sum(log10((coalesce(c, 0) + 0.1) / (n + 0.1 * (size + 1)))), 6) AS base_score,
 round(sum(log10(CASE WHEN cv IS NULL THEN p1 ELSE taken / cv + given / cv * p1 END)), 6) AS score FROM scored JOIN summed USING (r), total GROUP BY r, doc_id, held_out
"""
