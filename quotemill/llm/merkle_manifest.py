"""Merkle manifest of a dataset: stored levels of digests, and a recursive climb from every leaf to the root.

A row's leaf is the SHA-256 of its fields, each `-` if null, else the byte count of its
text, `:` and the text. Leaves of a source ascend by id (equal ids by leaf); while a level
has several nodes, every `fanout` consecutive ones become the digest of their hexadecimal
digests. What remains is the source's subroot; the subroots, in the order of their source
(null first, by bytes), become the root in the same way.

Levels are stored as rows that link to their parent: tree (the source's number; -1 above
the subroots), level, index, the digests of their children, and the place among the
parent's. A recursive query starts at every leaf, joins the parent's row, appends the
siblings' digests and folds the own one. Rows of steps carry only their own siblings;
they are put together once, at the end, so that long proofs aren't shuffled at every step;
neighbouring leaves, which share most siblings, are dealt together and so compress.
The upper nodes are met by all leaves below them: such a node is stored in one copy per
COPY leaves (MOST copies at most), dealt by the leaf's key, so no join has a hot key and
nothing is broadcast. Places in the order come from one range exchange whose partitions
are counted afterwards; no task holds a source.

A null id is an id before all others and a null source a source of its own; null and empty
texts have leaves of their own; texts are digested whole, however long; repeated rows are
separate leaves with equal digests, in any order among themselves; other columns may have
any name; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shared

FANOUT, COPY, MOST = 16, 4096, 4096
#: Tables of at most so many rows (by a count or a bound) stay in one task instead of being dealt.
FEW = 20_000
#: Characters of a digest.
HEX = 64
TOP = -1


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 of fields with their byte counts."""
    parts = []
    for c in columns:
        told = c.cast("string")
        parts.append(F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(told), F.lit(":"), told)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hexadecimal(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass
class Manifest:
    """Leaves (key, tree, idx, n, leaf, payload and link), inner nodes with their copies, and a row for each source."""

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame


def _few(df: DataFrame, rows: int) -> DataFrame:
    return df.coalesce(1) if rows <= FEW else df


def _numbered(rows: DataFrame, by: str, order: list[str], name: str, count: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (`count` of them, where known) with a unique `key`, their partition and place in it, in the order of `by` and `order`; and where each (part, by) begins in its `by`."""
    parts = shared.partitions(rows.sparkSession)
    keys = [F.col(by).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    dealt = rows.coalesce(1) if count is not None and count <= FEW else rows.repartitionByRange(parts, *keys)
    written = shared.keep(dealt.sortWithinPartitions(*keys).withColumn("key", F.monotonically_increasing_id()), name)
    placed = written.withColumns({"part": F.shiftright("key", 33), "row_no": F.col("key").bitwiseAND(F.lit((1 << 33) - 1))})
    runs = placed.groupBy("part", by).agg(F.min("row_no").alias("first"), F.count("*").alias("size"))
    before = F.sum("size").over(W.partitionBy(by).orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    return placed, runs.select("part", by, "first", "size", F.coalesce(before, F.lit(0)).alias("before"))


def _copies(weight: Column) -> Column:
    return F.least(F.greatest(F.floor(weight / COPY), F.lit(1)), F.lit(MOST)).cast("long")


def _build(level: DataFrame, count: int, trees: int, widest: int, fanout: int, name: str) -> list[DataFrame]:
    """Stored levels above (tree, idx, digest, n, weight), which has `count` rows of `trees` trees: each with its children's digests, until one node of every tree remains."""
    levels, n = [level], widest
    while n > 1:
        grouped = _few(level, count).where("n > 1").groupBy("tree", F.floor(F.col("idx") / fanout).alias("parent"))
        kids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda x: hexadecimal(x["digest"])), "")
        rows = grouped.agg(kids.alias("kids"), F.ceil(F.max("n") / fanout).alias("n"), F.sum("weight").alias("weight"))
        level = shared.keep(rows.select("tree", F.col("parent").alias("idx"), F.unhex(F.sha2("kids", 256)).alias("digest"), "n", "weight", "kids"), f"{name}-level")
        count = count // fanout + trees  # at most
        levels.append(_few(level, count))
        n = -(-n // fanout)
    return levels


def _linked(rows: DataFrame, level: int, fanout: int) -> DataFrame:
    """Rows of a level with the link to their parent: its tree, level, index and copies, and the place among its children; the last node of a tree has none."""
    of = W.partitionBy("tree", F.floor(F.col("idx") / fanout))
    inner = F.col("n") > 1
    copies = F.lit(1).cast("long") if level == 0 else _copies(F.sum("weight").over(of))
    return rows.withColumns({
        "up_tree": F.when(inner, F.col("tree")), "up_level": F.when(inner, F.lit(level + 1)), "up_idx": F.when(inner, F.floor(F.col("idx") / fanout)),
        "up_copies": F.when(inner, copies), "pos": F.when(inner, (F.col("idx") % fanout).cast("int")),
    })


LINK = ["up_tree", "up_level", "up_idx", "up_copies", "pos"]


def build_manifest(rows: DataFrame, order: str, source: str, payload: list[str], fanout: int = FANOUT) -> Manifest:
    """Levels over `rows` (with `leaf`, its digest): leaves by `order` within `source`, carrying `payload`."""
    spark = rows.sparkSession
    kept = rows.select(F.col(source).alias("source"), F.col(order).alias("order"), "leaf", *[F.col(c) for c in payload])
    placed, runs = _numbered(kept, "source", ["order", "leaf"], "merkle-leaves")
    runs = shared.keep(runs, "merkle-runs")
    n_runs, n_leaves = runs.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    runs = _few(runs, n_runs)
    sizes = runs.groupBy("source").agg(F.sum("size").alias("size")).withColumn("one", F.lit(0))
    numbered, starts = _numbered(sizes, "one", ["source"], "merkle-sources", n_runs)
    numbered, starts = _few(numbered, n_runs), _few(starts, n_runs)
    numbered = numbered.join(starts.select("part", "first", "before"), "part").select("source", "size", (F.col("before") + F.col("row_no") - F.col("first")).alias("tree"))
    sources = shared.keep(numbered, "merkle-trees")
    n_sources, widest = sources.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(0))).first()
    places = runs.join(sources.withColumnRenamed("source", "of").withColumnRenamed("size", "n"), F.col("source").eqNullSafe(F.col("of"))).select("part", F.col("source").alias("of"), "first", "before", "tree", "n")
    leaves = placed.join(places.withColumnRenamed("part", "of_part"), (F.col("part") == F.col("of_part")) & F.col("source").eqNullSafe(F.col("of")))
    leaves = leaves.select("key", "tree", (F.col("before") + F.col("row_no") - F.col("first")).alias("idx"), "n", "leaf", *payload)
    leaves = shared.keep(leaves, "merkle-placed")

    level0 = leaves.select("tree", "idx", F.col("leaf").alias("digest"), "n", F.lit(1).cast("long").alias("weight"))
    inner = _build(level0, n_leaves, n_sources, widest, fanout, "merkle-source")
    last = [x.where("n = 1").select("tree", "digest", "weight") for x in inner]
    subroots = last[0]
    for x in last[1:]:
        subroots = subroots.unionByName(x)
    # a lone leaf has the weight 1; of other trees the last node has that of all its leaves
    tops = shared.keep(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest", F.lit(n_sources).cast("long").alias("n"), "weight"), "merkle-subroots")
    upper = _build(tops, n_sources, 1, n_sources, fanout, "merkle-top")
    of = W.partitionBy(F.floor(F.col("idx") / fanout))
    above = _linked(tops, 0, fanout).withColumn("up_copies", F.when(F.col("n") > 1, _copies(F.sum("weight").over(of)))).select(F.col("idx").alias("of"), *[F.col(c).alias(f"top_{c}") for c in LINK])
    above = shared.keep(above, "merkle-links")

    def rooted(x: DataFrame) -> DataFrame:
        """Subroots are linked to the tree above."""
        linked = x.where("n = 1").drop(*LINK).join(above, F.col("tree") == F.col("of")).withColumnsRenamed({f"top_{c}": c for c in LINK}).drop("of")
        return x.where("n > 1").unionByName(linked)

    nodes = None
    for levels, below in ((inner, True), (upper, False)):
        for k, x in list(enumerate(levels))[1:]:
            linked = _linked(x, k, fanout)
            linked = (rooted(linked) if below else linked).select("tree", F.lit(k).alias("level"), "idx", "digest", "kids", F.lit(below).alias("_below"), (F.col("n") == 1).alias("_last"), _copies(F.col("weight")).alias("_copies"), *LINK)
            nodes = linked if nodes is None else nodes.unionByName(linked)
    if nodes is not None:
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("copy")
        nodes = shared.keep(nodes.select("tree", "level", "idx", copies, "digest", "kids", (F.col("_below") & F.col("_last")).alias("subroot"), *LINK), "merkle-nodes")
    else:
        nodes = spark.createDataFrame([], "tree long, level int, idx long, copy long, digest binary, kids string, subroot boolean, up_tree long, up_level int, up_idx long, up_copies long, pos int")
    return Manifest(rooted(_linked(leaves, 0, fanout)), nodes, sources)


CLIMB = """
WITH RECURSIVE climb AS (
 SELECT key, 0 AS step, up_tree, up_level, up_idx, up_copies, pos, start AS folded, CAST(NULL AS BINARY) AS siblings, leaf AS digest, n = 1 AS subroot, payload FROM {leaves}
 UNION ALL
 SELECT c.key, c.step + 1, p.up_tree, p.up_level, p.up_idx, p.up_copies, p.pos, unhex(sha2(overlay(p.kids PLACING lower(hex(c.folded)) FROM c.pos * {hex} + 1 FOR {hex}), 256)),
  unhex(concat(substr(p.kids, 1, c.pos * {hex}), substr(p.kids, (c.pos + 1) * {hex} + 1))), p.digest, p.subroot, NULL
 FROM climb c JOIN {nodes} p ON c.up_tree = p.tree AND c.up_level = p.level AND c.up_idx = p.idx AND pmod(c.key, c.up_copies) = p.copy
)
SELECT * FROM climb
"""


def climb(manifest: Manifest, start: Column, payload: list[str], digest: bool = False, lasting: bool = False) -> DataFrame:
    """For each leaf `payload` and its leaf, subroot, root, the siblings from the bottom up and from left to right as `proof`, and the root that `start` instead of the leaf folds to; digests are binary. With `digest` the column proof_sha256 stands for the proof."""
    spark, views = manifest.nodes.sparkSession, f"merkle_{uuid.uuid4().hex}"
    limit = "spark.sql.cteRecursionRowLimit"
    manifest.leaves.withColumns({"start": start, "payload": F.struct(*payload)}).createOrReplaceTempView(f"{views}_leaves")
    manifest.nodes.createOrReplaceTempView(f"{views}_nodes")
    held = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")  # there is a row for each leaf and step
        steps = spark.sql(CLIMB.format(leaves=f"{views}_leaves", nodes=f"{views}_nodes", hex=HEX))
        steps = steps.select(F.shiftright("key", 4).alias("near"), "key", "step", "folded", "siblings", "digest", "subroot", "payload").repartition(shared.partitions(spark), "near")
        proof = F.array_sort(F.collect_list(F.when(F.col("siblings").isNotNull(), F.struct("step", "siblings"))))
        ends = [F.max(F.when(F.col("step") == 0, F.struct("digest", "payload"))).alias("_first"), F.max(F.struct("step", "digest", "folded")).alias("_last"), F.max(F.when(F.col("subroot"), F.col("digest"))).alias("subroot")]
        found = steps.groupBy("near", "key").agg(proof.alias("_proof"), *ends)
        told = F.aggregate("_proof", F.lit(b""), lambda a, x: F.concat(a, x["siblings"]))
        told = F.sha2(hexadecimal(told), 256).alias("proof_sha256") if digest else told.alias("proof")
        result = found.select(*[F.col(f"_first.payload.{c}").alias(c) for c in payload], F.col("_first.digest").alias("leaf"), "subroot", F.col("_last.digest").alias("root"), told, F.col("_last.folded").alias("folded_root"))
        return shared.keep(result, "merkle-climb", lasting)
    finally:
        spark.conf.set(limit, held)
        spark.catalog.dropTempView(f"{views}_leaves")
        spark.catalog.dropTempView(f"{views}_nodes")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, subroot, root and proof, and whether the leaf of the text as found (of one in five its A-Z are lower-cased) still folds to the root."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    told = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0
    leaf, changed = leaf_digest([*fields, F.col("text")]), leaf_digest([*fields, lower_ascii(F.col("text"))])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", leaf.alias("leaf"), F.when(told, changed).alias("changed"))
    with shared.temporary(spark):
        manifest = build_manifest(rows, "doc_id", "source", ["doc_id", "changed"])
        found = climb(manifest, F.coalesce("changed", "leaf"), ["doc_id"], digest=True, lasting=True)
        told = {c: hexadecimal(F.col(c)) for c in ("leaf", "subroot", "root", "folded_root")}
        return found.select("doc_id", *[told[c].alias(c) for c in ("leaf", "subroot", "root")], "proof_sha256", told["folded_root"].alias("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"))


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {0})"
ORACLE_SQL = f"""
WITH RECURSIVE crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) AS v FROM range(256) AS r(i))),
summed AS (SELECT documents.*, CASE WHEN doc_id IS NULL THEN 1 ELSE xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) END AS h FROM documents, crc),
lowered AS (SELECT *, CASE WHEN h % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS found FROM summed),
digests AS (SELECT doc_id, source, {_LEAF.format(_FIELD.format("text"))} AS leaf, {_LEAF.format(_FIELD.format("found"))} AS start FROM lowered),
leaves AS (SELECT *, row_number() OVER () AS r, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM digests),
nodes AS (SELECT s, 0 AS level, i, leaf AS h, '' AS kids, n FROM leaves
 UNION ALL SELECT s, level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), string_agg(h, '' ORDER BY i), (max(n) + 15) // 16 FROM nodes WHERE n > 1 GROUP BY s, level, i // 16),
subroots AS (SELECT s, h FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, s AS i, h, '' AS kids, (SELECT count(*) FROM subroots) AS n FROM subroots
 UNION ALL SELECT level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), string_agg(h, '' ORDER BY i), (max(n) + 15) // 16 FROM tops WHERE n > 1 GROUP BY level, i // 16),
lower_steps AS (SELECT r, s, 0 AS level, i, start AS f, '' AS proof FROM leaves
 UNION ALL SELECT c.r, c.s, c.level + 1, c.i // 16, sha256(p.kids[:(c.i % 16) * 64] || c.f || p.kids[(c.i % 16 + 1) * 64 + 1:]), proof || p.kids[:(c.i % 16) * 64] || p.kids[(c.i % 16 + 1) * 64 + 1:]
 FROM lower_steps c JOIN nodes p ON p.s = c.s AND p.level = c.level + 1 AND p.i = c.i // 16),
half AS (SELECT r, s, max_by(f, level) AS f, max_by(proof, level) AS proof FROM lower_steps GROUP BY r, s),
upper_steps AS (SELECT r, 0 AS level, s AS i, f, proof FROM half
 UNION ALL SELECT c.r, c.level + 1, c.i // 16, sha256(p.kids[:(c.i % 16) * 64] || c.f || p.kids[(c.i % 16 + 1) * 64 + 1:]), proof || p.kids[:(c.i % 16) * 64] || p.kids[(c.i % 16 + 1) * 64 + 1:]
 FROM upper_steps c JOIN tops p ON p.level = c.level + 1 AND p.i = c.i // 16),
done AS (SELECT r, max_by(f, level) AS f, max_by(proof, level) AS proof FROM upper_steps GROUP BY r)
SELECT doc_id, leaf, subroots.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = root.h AS verified
FROM leaves JOIN done USING (r) JOIN subroots USING (s), (SELECT h FROM tops WHERE n = 1) root
"""
