"""Connected components of a table of links, by alternating large and small stars.

Each round lets every node link its neighbours to the smallest of them, which
keeps components as they are and flattens them to stars in about as many rounds
as the logarithm of the longest path. A round is two aggregations and two joins
on node ids; its links are written, so a lost executor never repeats earlier
rounds, and neither links nor components reach the driver. Once no more than
``FEW_LINKS`` are left, one task finishes them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import written

LINKS = "a bigint, b bigint"
#: So few links (16 bytes each) are flattened by one task instead of by further rounds.
FEW_LINKS = 300_000


def forest(pairs: list[tuple[int, int]] | np.ndarray) -> dict[int, int]:
    """Root (smallest node) of each node of some pairs."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def _stars(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of some batches as stars: the same components with fewer links."""
    pairs = [p for batch in batches for p in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
    star = [(x, r) for x, r in forest(pairs).items() if x != r]
    if star:
        a, b = zip(*star, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _contract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        yield from _stars([batch])


def _finish(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _stars(list(rows))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star operation on links with a > b."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("low"))
        moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select("a", F.col("low").alias("b")))
    return moved.filter("a <> b").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the links (bigint columns a, b); root is the component's smallest node."""
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    now = written(ordered.mapInArrow(_contract, LINKS).distinct(), "links")
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31))).first()
    last = mark(now)
    for _ in range(most_rounds):
        if last[0] <= FEW_LINKS:
            now = written(now.coalesce(1).mapInArrow(_finish, LINKS), "links")
            break
        now = written(_star(_star(now, True), False), "links")
        found = mark(now)
        if found == last:
            break
        last = found
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
