"""Mixing sources to target weights by hash-threshold histograms.

Each document gets a 60-bit hash. A source that must give ``target`` words
takes every document as often as the target holds the whole source, and once
more those whose hash is below a threshold. The threshold comes from sums of
sizes by source and hash bucket: the boundary bucket, in which the running sum
passes the budget, is the only one that the next level splits further. No
document is sorted, and what is shuffled are partial sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import SPACE_RUN, small, text_or_empty, written

HASH_BITS = 60
LEVEL_BITS = 12
#: Sources whose plan is broadcast at most (40 bytes each).
MOST_BROADCAST = 200_000


def word_count(text: Column) -> Column:
    """Number of words: the pieces between runs of white space, less empty ones at the ends."""
    return F.size(F.filter(F.split(text, SPACE_RUN), lambda w: w != "")).cast("long")


def mix_hash(doc_id: Column, seed: int) -> Column:
    """60 bits of the MD5 of the id and a seed; a null id hashes as the word null."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source: source_size and target.

    Sources are weighed by their place in code-point order (null last), the
    weights repeating. A target is the smaller of ``most`` times the source and
    its weight times one common factor, which is where resharing the excess by
    weight ends. The windows here run over one row per source.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), place)
    by = by.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    whole = Window.partitionBy()
    by = by.withColumn("rank", F.struct(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary")))
    filled = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(filled), F.lit(0.0))
    by = by.withColumn("factor", left / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(filled), F.lit(0.0))))
    open_factor = F.min_by("factor", F.when(F.col("factor") * F.col("w") <= F.col("cap"), F.col("rank"))).over(whole)
    target = F.coalesce(F.least(F.col("cap"), open_factor * F.col("w")), F.col("cap"))
    return by.select("source", "source_size", target.alias("target"))


def _boundaries(sizes: DataFrame, budgets: DataFrame, level: int) -> DataFrame:
    """Per source (sid) the boundary bucket of this level and the budget that is left before it.

    ``budgets``: sid, prefix (boundary of the level above), left. Sources whose
    bucket fits whole have no boundary and drop out.
    """
    shift = HASH_BITS - LEVEL_BITS * (level + 1)
    bucket = F.shiftright("h", shift)
    rows = sizes.filter("size > 0").join(budgets, "sid")
    if level:
        rows = rows.filter(F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
    sums = rows.groupBy("sid", "left", bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("before", before).filter("before <= left and before + size > left")
    return sums.select("sid", F.col("bucket").alias("prefix"), (F.col("left") - F.col("before")).alias("left"), "size", "n")


def _plan(docs: DataFrame, weights: Sequence[float], share: float, most: float, seed: int, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, DataFrame]:
    """The table of sizes, and per source (sid) its size, target, whole rounds and the hash below which documents are taken once more."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(text_or_empty(text_col)).alias("size"))
    sizes = written(picked.withColumn("h", mix_hash(F.col("id"), seed)).withColumn("sid", source_key(F.col("source"))), "mix-sizes")
    targets = written(source_targets(sizes, weights, share, most).withColumn("sid", source_key(F.col("source"))).coalesce(1), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("rounds", whole.cast("long"))
    found = written(targets.filter("source_size > 0").select("sid", F.lit(0).cast("long").alias("prefix"), (F.col("target") - F.col("rounds") * F.col("source_size")).alias("left")).coalesce(1), "mix-budgets")
    ends = None
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        found = written(_boundaries(sizes, found.select("sid", "prefix", "left"), level), f"mix-level{level}")
        last = shift == 0
        done = found if last else found.filter("n = 1")
        part = done.select("sid", F.shiftleft(F.col("prefix") + (2 * F.col("left") >= F.col("size")).cast("long"), shift).alias("below"))
        ends = part if ends is None else ends.unionByName(part)
        found = found.filter("n > 1")
        if last or found.isEmpty():
            break
    return sizes, targets.join(ends, "sid", "left").select("sid", "source_size", "target", "rounds", "below")


def source_key(source: Column) -> Column:
    """A source's 64-bit key; null is a source of its own."""
    return F.xxhash64(source.isNull(), source)


def _copies(h: Column) -> Column:
    return F.col("rounds") + F.coalesce((h < F.col("below")).cast("long"), F.lit(0).cast("long"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken and copies (how often the mix takes it).

    The document on a source's boundary is taken if that brings the source
    nearer to its target, so a source misses it by half a document at most.
    Defined cases: a null text has no words; a null source is a source of its
    own; repeated rows (same id) share a hash and are taken together; sources
    without words get a target of 0; an empty table gives no rows; other
    columns are ignored, whatever their names. Reruns agree, as hashes depend
    on the id and the seed alone.
    """
    sizes, plan = _plan(docs, weights, share, most, seed, id_col, text_col, source_col)
    copies = _copies(F.col("h"))
    return sizes.join(plan, "sid").select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).alias("taken"),
        copies.alias("copies"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, with all its columns.

    Texts stay where they are as long as the plan, one row of 40 bytes per
    source, is small enough to broadcast (its rows are counted); beyond that it
    is joined by a shuffle. Defined cases are those of ``mix_sources``; rows
    without words follow their hash like others, and go if their whole source
    has no words.
    """
    _, plan = _plan(docs, weights, share, most, seed, id_col, text_col, source_col)
    plan = written(plan.select(F.col("sid").alias("_sid"), F.col("rounds").alias("_r"), F.col("below").alias("_b")).coalesce(1), "mix-plan")
    names = docs.columns
    temp = [f"c{i}" for i in range(len(names))]
    at = dict(zip(names, temp, strict=True))
    rows = docs.toDF(*temp).withColumn("_sid", source_key(F.col(at[source_col]).cast("string")))
    plan = small(plan, MOST_BROADCAST)
    copies = F.col("_r") + F.coalesce((mix_hash(F.col(at[id_col]), seed) < F.col("_b")).cast("long"), F.lit(0).cast("long"))
    rows = rows.join(plan, "_sid").withColumn("_n", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
    return rows.select(*temp).toDF(*names)
