"""Grouped prefix join on word shingles.

A document is the set of its distinct 5-word shingles. Shingles are ordered by rising
document frequency, then by hash; two sets with 100 |A and B| >= 75 |A or B| share one of
their first n - ceil(0.75 n) + 1 shingles (the prefix). Steps:

1. count the document frequency of every shingle; those of two documents or more go to
   sorted hash arrays in the shared folder (a shingle of one document links nothing);
2. documents with the same set become one class; classes with the same size and prefix
   become one group, and only a group's prefix goes to the inverted lists;
3. classes that hold together are linked first: each goes with its set to one of its
   lists and is compared there with a few leaders, until that joins little more. No
   link is lost or invented by this; it spares the join the pairs inside a component;
4. group pairs of a list that lie in different components are joined in blocks, under
   bounds on size, position, shared shingles and parity bits, at the first shingle that
   both prefixes hold: only what passes becomes a row, and once. Then groups are expanded
   to their classes, bounded once more and verified in full.

`links` counts a row's links: the classes of a component are dealt out in blocks, and each
pair of blocks is counted as a matrix product, so no pair of a component becomes a row.

Frequencies are counted on 48 bits of the hash, which moves the order but loses no link;
sets hold 64 bits. Texts of fewer than five words have one shingle, texts without words
none: those link with nothing and stand alone. Null doc_ids take part and are named by the
others of their component (null where all are null). Repeated rows are links like any; rows
with one id and different texts are judged apart. Texts are read whole, however long; only
`doc_id` and `text` are read, so other columns may have any name. An empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays, shared
from .components import connected_components
from .textcore import map_texts, shingle_hashes, sorted_counts, word_hashes

LOW = np.uint64((1 << 48) - 1)
#: Parity bits of a set, in longs of 64.
LONGS = 16
BITS = np.uint64(64 * LONGS - 1)
SHARD_BYTES = 24 << 20
#: Leaders a list has in one round, and how many classes share them before a list is split.
LEADERS, SHARE = 24, 4096
#: Rounds of linking at most (what is left goes to the join, whatever their number).
ROUNDS = 5
#: Groups of a list in one block of the join.
BLOCK_GROUPS = 512
#: Pairs that are looked at in one step.
PAIRS = 1 << 18
#: Bounds of a block of classes whose links are counted together.
BLOCK_ROWS, BLOCK_BYTES, COLUMNS = 256, 8 << 20, 8192


def _sets(batch: pa.RecordBatch, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, sorted, and their numbers."""
    shingles, sizes = shingle_hashes(*word_hashes(*map_texts(batch)), words)
    ends, out = np.cumsum(sizes), []
    for b, n in zip(ends.tolist(), sizes.tolist()):
        one = np.sort(shingles[b - n : b])
        out.append(one[np.concatenate(([True], one[1:] != one[:-1]))] if n > 1 else one)
    return (np.concatenate(out) if out else shingles), np.array([len(x) for x in out], np.int64)


def document_frequencies(docs: DataFrame, words: int = 5) -> tuple[str, int, frozenset]:
    """Write the shingles of two documents or more with their frequency; gives the path, the number of shards and those there are."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    path, n = shared.new_path(spark, "frequencies"), max(shared.partitions(spark), size // SHARD_BYTES)

    def count(batches):
        held, size = [], 0

        def out():
            keys, counts = sorted_counts(np.concatenate(held) >> np.uint64(16))
            return arrays.blob_batch(list(arrays.shard_blobs(keys, counts, _shard(keys, n))))

        for batch in batches:
            for part in arrays.slices(batch):
                held.append(_sets(part, words)[0])
                size += len(held[-1])
                if size >= arrays.FLUSH:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, counts = arrays.merge_blobs(table)
        keys, counts = keys[counts > 1], counts[counts > 1]
        if len(keys):
            arrays.write_arrays(path, f"df-{shard:06d}", keys, np.minimum(counts, 65535).astype(np.uint16))
        return pa.table({"shard": pa.array([shard] * bool(len(keys)), pa.int32())})

    made = shared.keep(docs.select("text").mapInArrow(count, arrays.BLOBS).groupBy("shard").applyInArrow(merge, "shard int"), "made")
    return path, n, frozenset(r[0] for r in made.collect())  # a row for each file


def _shard(keys: np.ndarray, n: int) -> np.ndarray:
    return (keys * (n / float(1 << 48))).astype(np.int64).clip(0, n - 1)


def _frequency(keys: np.ndarray, path: str, n: int, made: frozenset, files: dict) -> np.ndarray:
    order = np.argsort(keys)
    asked, out = keys[order], np.ones(len(keys), np.uint64)
    shards = _shard(asked, n)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(shards)) + 1, [len(shards)])) if len(shards) else np.zeros(1, int)
    for a, b in zip(edges[:-1], edges[1:]):
        if (s := int(shards[a])) in made:
            if s not in files:
                files[s] = arrays.map_arrays(f"{path}/df-{s:06d}", np.uint64, np.uint16)
            held, counts = files[s]
            at = np.minimum(np.searchsorted(held, asked[a:b]), len(held) - 1)
            out[order[a:b]] = np.where(held[at] == asked[a:b], counts[at], 1)
    return out


SIGNED = "doc_id long, text_key long, n long, prefix_hash long, node long, tokens array<long>, shared binary, odd array<long>"


def signatures(docs: DataFrame, words: int = 5, percent: int = 75, doc_id: str = "doc_id") -> DataFrame:
    """A row's id and text hash, n, prefix_hash, node (hash of the set), tokens (the prefix's shared shingles, in order), and where there are tokens shared (all shared shingles) and odd (parity bits of the set)."""
    path, n_shards, made = document_frequencies(docs, words)

    def sign(batches):
        files: dict = {}
        for batch in batches:
            for part in arrays.slices(batch):
                shingles, sizes = _sets(part, words)
                keys = shingles >> np.uint64(16)
                df = _frequency(keys, path, n_shards, made, files)
                ranked = (df << np.uint64(48)) | keys
                ends, rows = np.cumsum(sizes), []
                for b, n in zip(ends.tolist(), sizes.tolist()):
                    own, order = shingles[b - n : b], np.sort(ranked[b - n : b])
                    prefix = order[: n - -(-percent * n // 100) + 1] if n else order
                    tokens = (prefix[prefix >= np.uint64(2 << 48)] & LOW).astype(np.int64)
                    shared_set = own[df[b - n : b] > 1].tobytes() if len(tokens) else None
                    digest = lambda x: xxhash.xxh3_64_intdigest(x.tobytes(), n) - (1 << 63)
                    odd = np.packbits(np.bincount((own & BITS).astype(np.int64), minlength=64 * LONGS).astype(np.uint8) & 1).view(np.int64) if len(tokens) else None
                    rows.append((n, digest(prefix & LOW), digest(own), tokens, shared_set, odd))
                cols = list(zip(*rows)) if rows else [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array(c, t) for c, t in zip(cols, kinds)]], names=[x.split()[0] for x in SIGNED.split(", ")])

    return shared.keep(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(sign, SIGNED), "signatures")


def _differ(columns, n_x: Column, n_y: Column, percent: int) -> Column:
    """Whether sets that differ in as many shingles as these bits allow the similarity."""
    differ = reduce(lambda x, y: x + y, [F.bit_count(c) for c in columns])
    return 100 * (n_x + n_y - differ) >= percent * (n_x + n_y + differ)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _lead(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of classes that are linked to a leader of their list; `rows` (token, salt, node, n, component, shared) are sorted by list within partitions."""

    def compare(batches):
        key, leaders, root = None, [], []
        for batch in batches:
            token, salt, node, n, component = (c.to_pylist() for c in batch.columns[:5])
            found: list[tuple[int, int]] = []
            for i, value in enumerate(batch.column(5)):
                if (token[i], salt[i]) != key:
                    key, leaders, root = (token[i], salt[i]), [], []
                own, done = np.frombuffer(value.as_buffer(), np.uint64), set()
                for k, (other, size, where, held) in enumerate(leaders):
                    if root[k] in done:
                        continue
                    if where == component[i]:
                        done.add(root[k])
                    elif 100 * min(size, n[i]) >= percent * max(size, n[i]):
                        common = _common(own, held)
                        if 100 * common >= percent * (n[i] + size - common):
                            found.append((node[i], other))
                            done.add(root[k])
                if done:
                    least = min(done)
                    root = [least if r in done else r for r in root]
                elif len(leaders) < LEADERS:
                    root.append(len(leaders))
                    leaders.append((node[i], n[i], component[i], own.copy()))
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(compare, "a long, b long")


def verify(pairs: DataFrame, classes: DataFrame, percent: int = 75) -> DataFrame:
    """Those pairs (a, b of nodes) whose sets are similar enough; sets hold the shingles that any two documents share."""
    right = classes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("set_b"))
    left = classes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("set_a"))

    def check(batches):
        for batch in batches:
            keep, n_a, n_b = [], batch.column(2).to_pylist(), batch.column(4).to_pylist()
            for i, (a, b) in enumerate(zip(batch.column(3), batch.column(5))):
                common = _common(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64))
                keep.append(100 * common >= percent * (n_a[i] + n_b[i] - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return pairs.join(right, "b").join(left, "a").select("a", "b", "n_a", "set_a", "n_b", "set_b").mapInArrow(check, "a long, b long")


def _named(members: DataFrame, links: DataFrame) -> DataFrame:
    """`members` with the component that its links, and the component it had, give."""
    known = members.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    names = connected_components(links.unionByName(known)).withColumnRenamed("component", "name")
    return members.join(names, "node", "left").select("node", "group", "n", F.coalesce("name", "component").alias("component"))


def _open_lists(entries: DataFrame, members: DataFrame) -> DataFrame:
    """Lists of two components or more: token, k (their classes), major (the component with most of them) and pairs (of classes in different components)."""
    cells = entries.join(members, "group").groupBy("token", "component").count()
    k, kk = F.sum("count").alias("k"), F.sum(F.col("count").cast("double") * F.col("count")).alias("kk")
    lists = cells.groupBy("token").agg(k, kk, F.max(F.struct("count", "component")).alias("most"), F.count("*").alias("components")).where("components > 1")
    return lists.select("token", "k", F.col("most.component").alias("major"), ((F.col("k").cast("double") * F.col("k") - F.col("kk")) / 2).alias("pairs"))


def _linked(classes: DataFrame, members: DataFrame, entries: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Members with the components that leaders of lists have found, and the lists still open."""
    before = float("inf")
    for turn in range(ROUNDS + 1):
        lists = shared.keep(_open_lists(entries, members), "open-lists")
        rows, across = lists.agg(F.coalesce(F.sum("k"), F.lit(0)), F.coalesce(F.sum("pairs"), F.lit(0.0))).first()
        # few enough for the join, or no longer falling
        if turn == ROUNDS or across <= rows or across > 0.8 * before:
            return members, lists
        before = across
        # the longest list first, then a drawn one, so that classes meet others
        order = F.col("k") if turn == 0 else F.xxhash64("token", F.lit(turn))
        chosen = entries.join(lists, "token").groupBy("group").agg(F.max(F.struct(order.alias("order"), "token", "k")).alias("list"))
        salt = F.pmod(F.xxhash64("node", F.lit(turn)), F.ceil(F.col("list.k") / SHARE))
        told = members.join(chosen, "group").select("node", "component", F.col("list.token").alias("token"), salt.cast("int").alias("salt"))
        sets = told.join(classes.select("node", "n", "shared"), "node").withColumn("draw", F.xxhash64("node", F.lit(turn)))
        dealt = sets.repartition(shared.partitions(classes.sparkSession), "token", "salt").sortWithinPartitions("token", "salt", "draw")
        links = _lead(dealt.select("token", "salt", "node", "n", "component", "shared"), percent)
        members = shared.keep(_named(members, shared.keep(links, "links")), "members")


def similar_classes(signed: DataFrame, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets that share a prefix shingle with others, and (node, component) of those that are linked to others."""
    rows = signed.where("n > 0").groupBy("node", "n", "prefix_hash")
    rows = rows.agg(*[F.first(c).alias(c) for c in ("tokens", "shared", "odd")], F.count("*").alias("copies"))
    classes = shared.keep(rows.where(F.size("tokens") > 0), "classes")
    names = classes.groupBy("n", "prefix_hash").agg(F.min("node").alias("group"))
    grouped = shared.keep(classes.join(names, ["n", "prefix_hash"]).select("node", "group", "n", "tokens", "odd", (F.octet_length("shared") / 8).cast("long").alias("common")), "grouped")
    at = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - F.size("tokens")  # the prefix begins with shingles of one document
    heads = grouped.where("node = `group`").select("group", "n", F.posexplode("tokens").alias("i", "token"), at.alias("at"))
    heads = heads.select("group", "n", "token", (F.col("at") + F.col("i")).cast("int").alias("position"), F.col("i").alias("place"))
    several = grouped.groupBy("group").agg(F.count("*").alias("size")).where("size > 1").select("group")
    long = heads.groupBy("token").agg(F.count("*").alias("n_groups")).where("n_groups > 1").select("token")
    alone = heads.join(several, "group", "left_semi").where("place = 0")  # classes of one group meet at its first shingle
    entries = heads.join(long, "token", "left_semi").unionByName(alone.join(long, "token", "left_anti"))
    entries = shared.keep(entries, "lists")

    members = grouped.select("node", "group", "n", F.col("node").alias("component"))
    members, lists = _linked(classes, members, entries.select("token", "group"), percent)

    told = grouped.select("node", "group", "odd", "common", "tokens").join(members.select("node", "component"), "node")
    bits = [F.array(*[f(F.col("odd")[k]) for k in range(LONGS)]).alias(name) for name, f in (("every", F.bit_and), ("some", F.bit_or))]
    groups = shared.keep(told.groupBy("group").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("common").alias("common"), F.first("tokens").alias("tokens"), *bits), "groups")
    pairs = shared.keep(_group_pairs(entries, lists, groups, percent), "group-pairs")

    side = grouped.select("node", "group", "n", "odd").join(members.select("node", "component"), "node")
    x, y = (side.select([F.col(k).alias(f"{k}_{s}") for k in side.columns]) for s in "xy")
    xor = [F.col("odd_x")[k].bitwiseXOR(F.col("odd_y")[k]) for k in range(LONGS)]
    once = "component_x <> component_y AND (group_x <> group_y OR node_x < node_y)"
    wanted = pairs.join(x, "group_x").join(y, "group_y").where(once).where(_differ(xor, F.col("n_x"), F.col("n_y"), percent))
    links = verify(shared.keep(wanted.select(F.col("node_x").alias("a"), F.col("node_y").alias("b")), "pairs"), classes, percent)
    return classes, _named(members, shared.keep(links, "links")).select("node", "component")


def _cells(entries: DataFrame, lists: DataFrame, groups: DataFrame) -> DataFrame:
    """The open lists' groups, dealt to cells (token, lo, hi) of two blocks of a list.

    Groups of a list's major component only meet groups of others, so its own pairs have no cell.
    """
    spans = entries.join(lists.select("token", "major"), "token").join(groups.select("group", F.col("lo").alias("from"), F.col("hi").alias("to")), "group")
    spans = spans.withColumn("is_major", F.expr("from = major AND to = major"))
    counts = spans.groupBy("token").agg(F.count_if("is_major").alias("m"), F.count_if(~F.col("is_major")).alias("o"))
    counts = counts.select("token", F.ceil(F.col("m") / BLOCK_GROUPS).cast("int").alias("m"), F.ceil(F.col("o") / BLOCK_GROUPS).cast("int").alias("o")).where("o > 0")
    spans = spans.join(counts, "token").withColumn("hash", F.xxhash64("group"))
    own = F.when(F.col("is_major"), F.expr("pmod(hash, m)")).otherwise(F.expr("m + pmod(hash, o)")).cast("int").alias("own")
    other = F.explode(F.when(F.col("is_major"), F.expr("sequence(m, m + o - 1)")).otherwise(F.expr("sequence(0, m + o - 1)"))).alias("other")
    return spans.select("token", "group", "n", "position", "place", own, other).select("token", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") <= F.col("other")).alias("left"), "group", "n", "position", "place")


def _wide(column: pa.Array) -> np.ndarray:
    """A list column of LONGS values each as a matrix."""
    return column.flatten().to_numpy().view(np.uint64).reshape(-1, LONGS)


def _cell_pairs(rows: pa.RecordBatch, percent: int):
    """Pairs of groups that pass all bounds, of the whole cells that `rows` hold (sorted by cell, left blocks first)."""
    col = {k: rows.column(i) for i, k in enumerate(rows.schema.names)}
    group, n, position, lo, hi, common = (col[k].to_numpy() for k in ("group", "n", "position", "lo", "hi", "common"))
    every, some, left = _wide(col["every"]), _wide(col["some"]), col["left"].to_numpy(zero_copy_only=False)
    size, at = rows.num_rows, np.arange(rows.num_rows)
    start = np.flatnonzero(_new_cell(rows))
    cell = np.repeat(np.arange(len(start)), np.diff(np.append(start, size)))
    end = np.append(start[1:], size)[cell]
    lefts = np.add.reduceat(left.astype(np.int64), start)[cell]
    two = (lefts > 0) & (lefts < end - start[cell])
    # a row meets those behind it in its block, itself where its classes lie apart, or all of the other block
    first = np.where(two, start[cell] + lefts, at + (lo == hi))
    counts = np.where(two & ~left, 0, np.maximum(end - first, 0))
    before: dict[int, frozenset] = {}

    def earlier(i: int) -> frozenset:
        if i not in before:
            before[i] = frozenset(col["earlier"][i].as_py())
        return before[i]

    piece = np.cumsum(counts) // PAIRS
    for rows_of in np.split(at, np.flatnonzero(np.diff(piece)) + 1):
        i = np.repeat(rows_of, counts[rows_of])
        ends = np.cumsum(counts[rows_of])
        j = np.repeat(first[rows_of] - ends + counts[rows_of], counts[rows_of]) + np.arange(len(i))
        may = ((lo[i] != hi[j]) | (hi[i] != lo[j])) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        i, j = i[may], j[may]
        most = np.minimum(np.minimum(n[i] - position[i], n[j] - position[j]), np.minimum(common[i], common[j]))
        may = (100 + percent) * most >= percent * (n[i] + n[j])
        i, j = i[may], j[may]
        for k in range(0, len(i), PAIRS // LONGS):
            x, y = i[k : k + PAIRS // LONGS], j[k : k + PAIRS // LONGS]
            differ = np.bitwise_count(every[x] & ~some[y]).sum(axis=1, dtype=np.int64) + np.bitwise_count(every[y] & ~some[x]).sum(axis=1, dtype=np.int64)
            may = 100 * (n[x] + n[y] - differ) >= percent * (n[x] + n[y] + differ)
            for x, y in zip(x[may].tolist(), y[may].tolist()):
                if x == y or earlier(x).isdisjoint(earlier(y)):
                    yield int(group[x]), int(group[y])


def _new_cell(rows: pa.RecordBatch) -> np.ndarray:
    """Whether each row is the first of its cell."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in ("token", "low", "high"):
        values = rows.column(rows.schema.get_field_index(name)).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return new


def _group_pairs(entries: DataFrame, lists: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(group_x, group_y) of groups of a list that may hold linked classes of different components.

    Every bound is checked before a pair becomes a row. A pair is taken at the first shingle that
    both prefixes hold; what is left from there on, on the shorter side, bounds the common shingles.
    Parity bits that all classes of one group have and none of the other differ for all their pairs.
    """
    cell = ["token", "low", "high"]
    dealt = _cells(entries, lists, groups).join(groups, "group").withColumn("earlier", F.slice("tokens", 1, F.col("place")))
    dealt = dealt.repartition(shared.partitions(entries.sparkSession), *cell).sortWithinPartitions(*cell, F.desc("left"))

    def compare(batches):
        held: list[pa.RecordBatch] = []

        def pairs():
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            a, b = zip(*found) if (found := list(_cell_pairs(whole, percent))) else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["group_x", "group_y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            last = int(np.flatnonzero(_new_cell(batch))[-1])
            if last:  # cells that end in this batch; the last one may go on
                held[-1] = batch.slice(0, last)
                yield pairs()
                held.append(batch.slice(last))
        if held:
            yield pairs()

    columns = [*cell, "left", "group", "n", "position", "lo", "hi", "common", "every", "some", "earlier"]
    return dealt.select(*columns).mapInArrow(compare, "group_x long, group_y long")


def _block_links(sets: list[np.ndarray], n: np.ndarray, copies: np.ndarray, left: np.ndarray, percent: int) -> np.ndarray:
    """For each set, the copies of the linked ones: of all others, or only across the two blocks where `left` tells two apart."""
    sizes = np.array([len(s) for s in sets])
    values, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    first = np.flatnonzero(new)
    often = np.diff(np.append(first, len(values))) > 1
    column, taken = (np.cumsum(often) - 1)[np.cumsum(new) - 1], often[np.cumsum(new) - 1]
    column, row = column[taken], row[taken]
    common = np.zeros((len(sets), len(sets)))
    for a in range(0, int(often.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, (a, a + COLUMNS))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[row[lo:hi], column[lo:hi] - a] = 1
        common += held @ held.T
    linked = 100 * common >= percent * (n[:, None] + n[None, :] - common)
    np.fill_diagonal(linked, False)
    if left.any() and not left.all():
        linked &= left[:, None] != left[None, :]
    return linked @ copies


def link_counts(classes: DataFrame, found: DataFrame, percent: int = 75) -> DataFrame:
    """(node, more): how many rows of other classes each class is linked to."""
    known = classes.join(found, "node").select("component", "node", "n", "copies", "shared")
    sizes = known.groupBy("component").agg(F.count("*").alias("m"), F.sum(F.octet_length("shared")).alias("bytes")).where("m > 1")
    blocks = sizes.select("component", F.greatest(F.ceil(F.col("m") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    dealt = known.join(blocks, "component").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = ["component", "lo", "hi"]
    dealt = dealt.select("component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") <= F.col("other")).alias("left"), "node", "n", "copies", "shared")
    dealt = dealt.repartition(shared.partitions(classes.sparkSession), *cell).sortWithinPartitions(*cell)

    def count(batches):
        held: list[tuple] = []
        out: list[tuple[int, int]] = []

        def done():
            if len(held) > 1:
                _, left, node, n, copies, sets = zip(*held)
                more = _block_links(list(sets), np.array(n), np.array(copies), np.array(left), percent)
                out.extend((i, m) for i, m in zip(node, more.tolist()) if m)
            held.clear()

        def batch_of():
            a, b = zip(*out) if out else ((), ())
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["node", "more"])

        for batch in batches:
            component, lo, hi, left, node, n, copies = (c.to_pylist() for c in batch.columns[:7])
            for i, value in enumerate(batch.column(7)):
                key = (component[i], lo[i], hi[i])
                if held and held[0][0] != key:
                    done()
                held.append((key, left[i], node[i], n[i], copies[i], np.frombuffer(value.as_py(), np.uint64)))
            yield batch_of()
        done()
        yield batch_of()

    return dealt.mapInArrow(count, "node long, more long").groupBy("node").agg(F.sum("more").alias("more"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75, doc_id: str = "doc_id", links: bool = False) -> DataFrame:
    """doc_id, text_key (hash of the text), n_shingles, component_id (the smallest doc_id that links reach) and component of every row; with `links` also n_links, its number of linked rows."""
    signed = signatures(docs, words, percent, doc_id)
    classes, found = similar_classes(signed, percent)
    rows = signed.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    if links:
        copies = signed.where("n > 0").groupBy("node").agg((F.count("*") - 1).alias("copies"))
        rows = rows.join(copies, "node", "left").join(link_counts(classes, found, percent), "node", "left")
        rows = rows.withColumn("n_links", F.coalesce("copies", F.lit(0)) + F.coalesce("more", F.lit(0))).drop("copies", "more")
    rows = shared.keep(rows.drop("node"), "named")
    names = rows.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = rows.where("n_shingles > 0").join(names, "component")
    alone = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id")).withColumn("component", F.lit(None).cast("long"))
    return named.unionByName(alone).select("doc_id", "text_key", "n_shingles", "component_id", "component", *["n_links"] * links)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component and number of links of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, links=True).select("doc_id", "n_shingles", "component_id", "n_links")


#: The query in DuckDB: all pairs with a shingle in common, then the closure of their links.
ORACLE_SQL = """
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
shingles AS (SELECT DISTINCT r, s FROM (SELECT r, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' ')) WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS s FROM docs)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes sx ON sx.r = x JOIN sizes sy ON sy.r = y WHERE 100 * c >= 75 * (sx.n + sy.n - c)),
sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT r, r AS m FROM docs UNION SELECT reach.r, sides.y FROM reach JOIN sides ON sides.x = reach.m),
named AS (SELECT reach.r, min(docs.doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.m GROUP BY reach.r),
counted AS (SELECT x AS r, count(*) AS n_links FROM sides GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links FROM docs JOIN named USING (r) LEFT JOIN sizes USING (r) LEFT JOIN counted USING (r)
"""
