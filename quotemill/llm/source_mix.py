"""Mixing sources to target weights by a low-discrepancy schedule.

Sizes are words. Each source's documents, in a hashed order, form a stream that is cut
into blocks of `block` words. Slot k of the schedule has the point frac((k + 1/2) * phi);
the cumulative weights map it to a source; the slot's rank within that source names the
epoch and the block it takes. A join of slots and blocks gives what is taken of each
document; the last slot of a source is cut where the target ends, so a source takes its
rounded target and no document more than `max_epochs` times its words.

A null or empty text has size 0 and takes nothing; a null source is a source of its own;
repeated rows are separate documents; texts are read whole, however long; documents whose
hashes are equal follow in order of their id and text; other columns may have any name and
are carried along by `mixed_documents`; an empty table gives an empty result. Prefix sums
run in two levels (within hashed buckets, then over buckets), so a source of any size
spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shared

PHI = 0.6180339887498949
GRID = 1024


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; null counts 0."""
    plain = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(F.size(F.filter(F.split(plain, " "), lambda w: w != "")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: int = 3) -> DataFrame:
    """A row for each source: its order, size and target.

    Targets are min(max_epochs * size, level * weight), with the level that shares all words:
    what resharing the excess by weight comes to when none is above.
    """
    rows = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = rows.withColumn("ord", (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int"))
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("ord") % len(weights) + 1))
    rows = rows.withColumn("cap", (F.col("source_size") * max_epochs).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    every, before = W.partitionBy(F.lit(0)), W.partitionBy(F.lit(0)).orderBy("ratio", "ord").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({
        "_words": F.sum("source_size").over(every).cast("double"),
        "_weight": F.sum("weight").over(every),
        "_cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "_weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    rows = rows.withColumn("_full", F.col("_words") - F.col("_cap_before") >= F.col("ratio") * (F.col("_weight") - F.col("_weight_before")))
    rows = rows.withColumn("_left", F.col("_words") - F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0.0)).over(every))
    rows = rows.withColumn("_open", F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("weight"))).over(every))
    target = F.when(F.col("_full"), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.try_divide("_left", "_open")))
    return rows.select("source", "ord", "source_size", target.alias("target"))


def _ranges(targets: DataFrame, block: int) -> DataFrame:
    """Add each source's number of slots, where its last epoch ends, and its part of [0, 1)."""
    size, target = F.col("source_size"), F.round("target").cast("long")
    rows = targets.withColumn("last_epoch", F.when(size > 0, F.floor(target / size)).otherwise(0).cast("long"))
    rows = rows.withColumn("last_words", F.when(size > 0, target - F.col("last_epoch") * size).otherwise(0))
    rows = rows.withColumn("n_blocks", F.ceil(size / block)).withColumn("n_slots", F.col("last_epoch") * F.col("n_blocks") + F.ceil(F.col("last_words") / block))
    to = W.partitionBy(F.lit(0)).orderBy("ord")
    total = F.sum("n_slots").over(W.partitionBy(F.lit(0)))
    rows = rows.withColumn("hi", F.try_divide(F.sum("n_slots").over(to).cast("double"), total))
    return rows.withColumn("lo", F.coalesce(F.lag("hi").over(to), F.lit(0.0)))


def schedule(ranges: DataFrame, block: int, chunk_bits: int = 16) -> DataFrame:
    """Slots: slot, ord, epoch, block, upto (the source's word where the slot's part of the block ends)."""
    spark = ranges.sparkSession
    total = ranges.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    x = (F.col("id") + 0.5) * PHI
    points = spark.range(0, total, 1, max(1, min(shared.partitions(spark), 1 + total // 50_000))).select(F.col("id").alias("slot"), (x - F.floor(x)).alias("x"))
    points = points.withColumn("cell", F.floor(F.col("x") * GRID).cast("int"))
    used = ranges.where("n_slots > 0")
    cells = used.select("ord", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * GRID).cast("int"), F.least(F.floor(F.col("hi") * GRID), F.lit(GRID - 1)).cast("int"))).alias("cell"))
    dealt = points.join(cells, "cell").where((F.col("x") >= F.col("lo")) & (F.col("x") < F.col("hi"))).select("slot", "ord", F.shiftright("slot", chunk_bits).alias("chunk"))
    counts = dealt.groupBy("ord", "chunk").count()
    before = W.partitionBy("ord").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("ord", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = dealt.withColumn("k", F.row_number().over(W.partitionBy("ord", "chunk").orderBy("slot"))).join(offsets, ["ord", "chunk"])
    ranked = ranked.select("slot", "ord", (F.col("before") + F.col("k") - 1).alias("rank"))
    # the points give a source a few slots more or less than its share: the surplus goes, the rest comes last
    have = counts.groupBy("ord").agg(F.sum("count").alias("have"))
    short = used.join(have, "ord", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < n_slots")
    late = short.select("ord", F.explode(F.sequence(F.col("have"), F.col("n_slots") - 1)).alias("rank")).select((F.col("rank") + total).alias("slot"), "ord", "rank")
    slots = ranked.unionByName(late).join(used.select("ord", "n_slots", "n_blocks", "source_size", "last_epoch", "last_words"), "ord").where("rank < n_slots")
    slots = slots.withColumn("epoch", F.floor(F.col("rank") / F.col("n_blocks"))).withColumn("block", F.col("rank") % F.col("n_blocks"))
    upto = F.least((F.col("block") + 1) * block, F.when(F.col("epoch") < F.col("last_epoch"), F.col("source_size")).otherwise(F.col("last_words")))
    return slots.select("slot", "ord", "epoch", "block", upto.alias("upto"))


def document_blocks(sized: DataFrame, targets: DataFrame, block: int, seed: int = 0) -> DataFrame:
    """Sized documents with their place in their source's shuffled stream; a row for each block they touch (block null: none)."""
    rows = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    key = F.xxhash64("doc_id", F.lit(seed))
    rows = rows.withColumn("_key", key).withColumn("_bucket", F.shiftright("_key", 52))
    inner = W.partitionBy("ord", "_bucket").orderBy("_key", "doc_id", "row_hash")
    sums = rows.groupBy("ord", "_bucket").agg(F.sum("size").alias("_words"))
    outer = W.partitionBy("ord").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("ord", "_bucket", F.coalesce(F.sum("_words").over(outer), F.lit(0)).alias("_base"))
    rows = rows.withColumn("rn", F.row_number().over(inner)).withColumn("_in", F.coalesce(F.sum("size").over(inner.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.join(sums, ["ord", "_bucket"]).withColumn("begin", F.col("_base") + F.col("_in"))
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("size") - 1) / block)))
    return rows.select("*", F.explode_outer(blocks).alias("block")).drop("_key", "_base", "_in")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: int = 3, block: int = 1024, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(pieces, slots): the documents' parts of blocks with each source's target, and the schedule; joined on ord and block they are the mix."""
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("row_hash"))
    sized = shared.keep(sized, "mix-sizes")
    targets = shared.keep(_ranges(source_targets(sized, weights, max_epochs), block), "mix-targets")
    pieces = document_blocks(sized, targets.select("source", "ord", "source_size", "target"), block, seed)
    return pieces, schedule(targets, block)


def mix_digest(pieces: DataFrame, slots: DataFrame, block: int = 1024, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row for each document, with `carry` of its columns: doc_id, size, source_size, target, taken, and copies (epochs that take its first word; 1 for a text without words)."""
    begin, end = F.greatest("begin", F.col("block") * block), F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block)
    got = F.when(F.col("upto").isNotNull(), F.greatest(F.least(end, F.col("upto")) - begin, F.lit(0)))
    first = (F.col("begin") >= F.col("block") * block) & (F.col("upto") > F.col("begin"))
    joined = pieces.join(slots.select("ord", "block", "upto"), ["ord", "block"], "left")
    return (
        joined.groupBy("ord", "_bucket", "rn", "doc_id", "row_hash", "size", "source_size", "target", *carry)
        .agg(F.coalesce(F.sum(got), F.lit(0)).cast("long").alias("taken"), F.coalesce(F.sum(F.when(first, 1).otherwise(0)), F.lit(0)).alias("_copies"))
        .select(*carry, "doc_id", "row_hash", "size", "source_size", "target", "taken", F.when(F.col("size") == 0, 1).otherwise(F.col("_copies")).cast("int").alias("copies"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of `docs`: each document as often as an epoch takes it; columns as given."""
    block = options.get("block", 1024)
    digest = mix_digest(*mix_sources(docs, **options), block, ("source",))
    same = W.partitionBy("source", "doc_id", "row_hash")
    counts = digest.withColumn("row_no", F.row_number().over(same.orderBy(F.desc("copies")))).where("copies > 0")
    counts = counts.select(F.col("source").alias("_source"), F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"), F.col("row_no").alias("_no"), F.col("copies").alias("_copies_of"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[F.col(f"`{options.get(c, c)}`").alias(c) for c in ("source", "doc_id")], F.xxhash64(options.get("text", "text")).alias("hash"))
    rows = rows.withColumn("no", F.row_number().over(W.partitionBy("source", "doc_id", "hash").orderBy(F.xxhash64("row"))))
    joined = rows.join(counts, rows["source"].eqNullSafe(counts["_source"]) & rows["doc_id"].eqNullSafe(counts["_id"]) & (F.col("hash") == F.col("_hash")) & (F.col("no") == F.col("_no")))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies_of")))).select("row.*")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mix_digest(*mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))).select("doc_id", "size", "source_size", "target", "taken", "copies")
