"""Approximate nearest neighbours by collision-counting hashing.

Vectors are projected on a number of random directions, and each projection is
kept as a sorted array, cut into ``CELLS`` cells of equally many vectors. A query
looks at the window around its own projection in each array; windows widen step
by step (virtual rehashing) until enough vectors stand in the windows of enough
projections. Only those are verified by their exact inner products. How far to
widen is found on a sample of the shard, then all vectors' collisions are counted
at that width in one pass over the cells, whole vectors of numbers at a time; if
fewer pass the bar than the sample promised, the windows widen on, and if more
do, the bar is raised.

The largest inner product becomes the least distance by one more coordinate,
which brings all vectors to the same length (and is 0 in queries).

Equal vectors are one class. Classes are dealt into shards of bounded size,
queries into blocks of bounded size, and every block meets every shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import written


#: Cells of a sorted array, and vectors whose cells are looked at together (they fit a processor's cache).
CELLS, TILE = 256, 4096


@dataclass(frozen=True)
class Search:
    """Projections (255 at most), the share of windows a candidate must be in, first half-width and growth (of the vectors' common length); windows widen until ``least`` k vectors and the share ``verified`` of all pass."""

    projections: int = 128
    collisions: float = 0.85
    first: float = 0.8
    growth: float = 1.15
    verified: float = 0.07
    least: int = 20
    shard: int = 16_384
    block: int = 2048
    sample: int = 512
    seed: int = 17


class Shard:
    """The sorted projections of some vectors."""

    def __init__(self, vectors: np.ndarray, search: Search):
        self.search, self.vectors = search, vectors.astype("float64")
        n, m = len(vectors), search.projections
        norms = (self.vectors**2).sum(axis=1)
        self.length = float(np.sqrt(norms.max()))
        extra = np.sqrt(np.maximum(norms.max() - norms, 0))
        rng = np.random.default_rng(search.seed)
        self.directions = rng.standard_normal((m, vectors.shape[1] + 1))
        projected = (np.concatenate([self.vectors, extra[:, None]], axis=1) @ self.directions.T).T
        order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, order, axis=1)
        cells = np.empty((m, n), "u1")
        np.put_along_axis(cells, order, (np.arange(n) * CELLS // n).astype("u1")[None], axis=1)
        self.tiles = [np.ascontiguousarray(cells[:, at : at + TILE]) for at in range(0, n, TILE)]
        few = np.arange(0, n, max(1, n // search.sample))
        self.sample = np.ascontiguousarray(cells[:, few])
        self.bar = int(np.ceil(search.collisions * m))

    def windows(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First cell and number of further cells of each window (query, step, projection); the last step takes in all cells."""
        s, n = self.search, len(self.vectors)
        scale = self.length / np.sqrt((queries**2).sum(axis=1))
        at = self.directions[:, :-1] @ (queries * scale[:, None]).T
        far = max(float(np.abs(self.sorted).max() + np.abs(at).max()), s.first * self.length) * 1.01
        steps = int(np.ceil(np.log(far / (s.first * self.length)) / np.log(s.growth)))
        widths = s.first * self.length * s.growth ** np.arange(steps + 1)
        place = lambda sign, side: np.stack([np.searchsorted(row, (x[:, None] + sign * widths).ravel(), side).reshape(len(x), -1) for row, x in zip(self.sorted, at, strict=True)], axis=2)
        low = np.minimum(place(-1, "left"), n - 1) * CELLS // n
        high = np.maximum(place(1, "right") - 1, 0) * CELLS // n
        return low.astype("u1"), np.maximum(high - low, 0).astype("u1")

    @staticmethod
    def _collisions(cells: np.ndarray, low: np.ndarray, more: np.ndarray) -> np.ndarray:
        """In how many windows each vector stands; numbers below a window wrap round to large ones."""
        inside = cells - low[:, None] <= more[:, None]
        return np.add.reduce(inside.view("u1"), axis=0, dtype="u1")

    def nearest(self, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the places and scores of at least ``k`` verified vectors (all, if fewer)."""
        n, few = len(self.vectors), self.sample.shape[1]
        wanted = min(max(self.search.least * k, int(np.ceil(self.search.verified * n))), n)
        for at in range(0, len(queries), 64):
            part = queries[at : at + 64]
            low, more = self.windows(part)
            for query, begin, width in zip(part, low, more, strict=True):
                # The first step at which the sample promises enough vectors over the bar.
                step, last = 0, len(begin) - 1
                while step < last:
                    half = (step + last) // 2
                    passing = int((self._collisions(self.sample, begin[half], width[half]) >= self.bar).sum())
                    step, last = (step, half) if passing * n >= wanted * few else (half + 1, last)
                while True:
                    count = np.concatenate([self._collisions(t, begin[step], width[step]) for t in self.tiles])
                    passing = np.cumsum(np.bincount(count, minlength=self.search.projections + 1)[::-1])[::-1]
                    # A sample may promise too much; then the windows widen on.
                    if passing[self.bar] >= wanted or step == len(begin) - 1:
                        break
                    step += 1
                # Of the vectors over the bar only those with the most collisions are needed.
                bar = max(self.bar, int(np.flatnonzero(passing >= wanted)[-1]))
                found = np.flatnonzero(count >= bar)
                yield found, self.vectors[found] @ query


def _usable(vector: Column) -> Column:
    """Finite, without nulls, not all zeros."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, search: Search | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each query row by inner product: query_id, rank, vec_id, score; ties go to smaller ids.

    ``is_query`` is a condition on the id column, named ``vec_id``. Candidates
    are all rows but the query's own. Defined cases: vectors that are null,
    empty, zero or hold nulls or numbers that are not finite take no part, nor
    do vectors of another dimension than most or rows without an id; of repeated
    rows (same id and vector) one counts, and a repeated id with other vectors
    is a candidate for each; fewer than ``k`` candidates give fewer rows; other
    columns are ignored.
    """
    search = search or Search()
    spark = vectors.sparkSession
    kind = vectors.schema[vector_col].dataType.simpleString()
    v = F.col(vector_col) if kind == "array<float>" else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & _usable(F.col("v")))
    most = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not most:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.filter(F.size("v") == most[0].d).distinct()

    # Classes of equal vectors with their k + 1 smallest ids (a query drops its own).
    head = Window.partitionBy("v").orderBy("vec_id")
    ids = rows.withColumn("nth", F.row_number().over(head)).filter(F.col("nth") <= k + 1)
    ids = ids.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = rows.filter(is_query).select("v").distinct().withColumn("asked", F.lit(True))
    classes = ids.join(asked, "v", "left").select(F.col("ids")[0].alias("cid"), F.xxhash64("v").alias("h"), "v", "ids", F.coalesce("asked", F.lit(False)).alias("asked"))
    classes = written(classes, "vector-classes")
    size = classes.agg(F.count("*").alias("n"), F.count_if("asked").alias("q")).first()
    shards, blocks = max(1, -(-size.n // search.shard)), max(1, -(-size.q // search.block))
    pick = lambda n, seed: F.pmod(F.xxhash64("cid", F.lit(seed)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = classes.select("cid", "h", "v", pick(shards, 1).alias("shard"), each(blocks).alias("block"))
    asking = classes.filter("asked").select("cid", "h", "v", pick(blocks, 2).alias("block"), each(shards).alias("shard"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            matrix = lambda t: t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            cids, tags = left.column("cid").to_numpy(), left.column("h").to_numpy()
            index = Shard(matrix(left), search)
            queries = matrix(right).astype("float64")
            for q, tag, (place, score) in zip(right.column("cid").to_numpy(), right.column("h").to_numpy(), index.nearest(queries, k + 1), strict=True):
                best = place[top := np.lexsort((cids[place], -score))[: k + 1]]
                m = len(best)
                out.append((np.full(m, q), np.full(m, tag), cids[best], tags[best], score[top]))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, t) for t in ("i8", "i8", "i8", "i8", "f8")]
        return pa.table([pa.array(c) for c in cols], names=["qcid", "qh", "cid", "h", "score"])

    met = data.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block")).applyInArrow(meet, "qcid bigint, qh bigint, cid bigint, h bigint, score double")
    met = written(met, "vector-hits")
    by_class = Window.partitionBy("qcid", "qh")
    met = met.withColumn("nth", F.row_number().over(by_class.orderBy(F.desc("score"), "cid"))).filter(F.col("nth") <= k + 1)
    hits = met.join(classes.select("cid", "h", "ids"), ["cid", "h"]).select("qcid", "qh", "score", F.explode("ids").alias("vec_id"))
    hits = hits.withColumn("nth", F.row_number().over(by_class.orderBy(F.desc("score"), "vec_id"))).filter(F.col("nth") <= k + 1).drop("nth")

    # Each query row takes its class's list without itself.
    asker = rows.filter(is_query).join(classes.filter("asked").select(F.col("v"), F.col("cid").alias("qcid"), F.col("h").alias("qh")), "v")
    asker = asker.select(F.col("vec_id").alias("query_id"), "qcid", "qh")
    own = Window.partitionBy("query_id", "qcid", "qh").orderBy(F.desc("score"), "vec_id")
    out = asker.join(hits, ["qcid", "qh"]).filter("vec_id <> query_id").withColumn("rank", F.row_number().over(own))
    return out.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
