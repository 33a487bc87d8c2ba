"""Centroid clustering in whole numbers, filtered by PCA-rotated coordinates.

The vectors' covariance, summed over all rows, gives an orthogonal rotation. Each
vector is stored with its first ``lead`` rotated coordinates and the norm of the
rest; so is each centroid. The squared distance of the leading coordinates plus
the squared difference of the two norms never exceeds the squared distance, so a
centroid whose bound lies above the exact distance of another needs no look. The
others are verified by exact whole-number distances; the rotation therefore
decides only how much is verified, never the result.

A round is one pass over the stored table. Each task sums its vectors by cluster;
Spark adds those sums up and only one sum per cluster and component reaches the
driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import discard, release, written

#: Vectors longer than this (in whole numbers) could have squared distances that no long holds.
LONGEST = float(1 << 30)
#: Vectors handled at once in a task.
ROWS = 8192


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds neither nulls nor numbers that are not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as lists."""
    n, width = rows.shape
    flat = pa.array(np.ascontiguousarray(rows).ravel(), kind)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="i4") * width), flat)


def whole_numbers(vectors: np.ndarray, scale: int, longest: float) -> np.ndarray:
    """floor(scale * x) of every component."""
    scaled = np.floor(vectors.astype("float64") * scale)
    with np.errstate(over="ignore"):
        if len(scaled) and (scaled**2).sum(axis=1).max() > longest**2:
            raise ValueError(f"vectors times {scale} must not be longer than {longest:.0f}: their squared distances would not fit a long")
    return scaled.astype("int64")


def batches_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def summed(parts: DataFrame, value: str = "sums", kind: str = "bigint") -> np.ndarray:
    """Elementwise sums of the arrays that the tasks made; their length is bounded, not their number."""
    each = parts.select(F.posexplode(value).alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast(kind)).alias("x"))
    got = each.collect()
    out = np.zeros(len(got), "float64" if kind == "double" else "int64")
    for r in got:
        out[r["at"]] = r["x"]
    return out


@dataclass
class Rotation:
    """An orthogonal matrix whose first ``lead`` rows are the directions in which vectors differ most."""

    matrix: np.ndarray
    lead: int

    def split(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading rotated coordinates and the norms of the rest."""
        turned = vectors @ self.matrix.T
        return turned[:, : self.lead], np.sqrt((turned[:, self.lead :] ** 2).sum(axis=1))


def fit_rotation(vectors: DataFrame, dims: int, lead: int) -> Rotation:
    """The principal directions of all vectors (array<double> column v)."""
    upper = np.triu_indices(dims)

    def moments(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + dims + len(upper[0]))
        for batch in batches_of(rows):
            v = matrix(batch.column("v"))
            total += np.concatenate([[len(v)], v.sum(axis=0), (v.T @ v)[upper]]) if len(v) else 0
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["sums"])

    total = summed(vectors.select("v").mapInArrow(moments, "sums array<double>"), kind="double")
    if not len(total) or not total[0]:
        return Rotation(np.eye(dims), min(lead, dims))
    mean, square = total[1 : dims + 1] / total[0], np.zeros((dims, dims))
    square[upper] = total[dims + 1 :] / total[0]
    covariance = square + np.triu(square, 1).T - np.outer(mean, mean)
    _, directions = np.linalg.eigh(covariance)
    return Rotation(np.ascontiguousarray(directions[:, ::-1].T), min(lead, dims))


class Centroids:
    """Whole-number centroids with their stored coordinates and norms."""

    def __init__(self, centres: np.ndarray, rotation: Rotation):
        self.centres = centres
        self.lead, self.rest = rotation.split(centres.astype("float64"))
        self.square = (centres.astype("float64") ** 2).sum(axis=1)

    def nearest(self, vectors: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and exact squared distance of each vector's nearest centroid (ties: smaller number), and how many distances were computed."""
        k, n = len(self.centres), len(vectors)
        bound = np.stack([((lead - self.lead[j]) ** 2).sum(axis=1) + (rest - self.rest[j]) ** 2 for j in range(k)], axis=1)
        guess = bound.argmin(axis=1)
        step = vectors - self.centres[guess]
        best, cluster = (step * step).sum(axis=1), guess.copy()
        # Rounding moves a bound by far less than this share of the squared lengths.
        slack = 1e-9 * ((lead**2).sum(axis=1) + rest**2)[:, None] + 1e-9 * self.square + 1e-3
        survivor = bound <= best[:, None] + slack
        survivor[np.arange(n), guess] = False
        for j in range(k):
            at = np.flatnonzero(survivor[:, j] & (bound[:, j] <= best + slack[:, j]))
            if len(at):
                step = vectors[at] - self.centres[j]
                d = (step * step).sum(axis=1)
                nearer = (d < best[at]) | ((d == best[at]) & (j < cluster[at]))
                best[at[nearer]], cluster[at[nearer]] = d[nearer], j
        return cluster, best, n + int(survivor.sum())


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return matrix(batch.column("v")).astype("int64"), matrix(batch.column("lead")), batch.column("rest").to_numpy()


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3, dims: int = 64, lead: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: id, cluster, distance, centroid (array), cluster_inertia, inertia.

    Kept are vectors of exactly ``dims`` components, none null or not finite;
    component x counts as floor(scale * x). Centroids start as the ``k`` vectors
    whose ``seed:id`` has the smallest sha256 and move ``rounds`` times to the
    floor of their vectors' mean. Defined cases: each row counts, repeated ones
    too, and rows of one id start in the order of their vectors; vectors without
    an id are clustered but start only if fewer than ``k`` others are kept; fewer
    than ``k`` vectors give fewer clusters; no vectors, no rows; a vector longer
    than ``LONGEST`` in whole numbers is an error, as its distances fit no long;
    other columns are ignored.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).filter((F.size("v") == dims) & finite(F.col("v")))
    kind = rows.schema["id"].dataType.simpleString()

    rotation = fit_rotation(rows, dims, lead)

    def turned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(parts):
            ints = whole_numbers(matrix(batch.column("v")).reshape(-1, dims), scale, LONGEST)
            first, rest = rotation.split(ints.astype("float64"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists(ints, pa.int32()), lists(first, pa.float64()), pa.array(rest)], ["id", "v", "lead", "rest"])

    stored = written(rows.mapInArrow(turned, f"id {kind}, v array<int>, lead array<double>, rest double"), "centroid-vectors")
    name = F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))
    first = stored.orderBy(F.sha2(name.cast("binary"), 256).asc_nulls_last(), "v").limit(k).select("v").collect()
    centres = np.array([r["v"] for r in first], "int64").reshape(len(first), dims)

    def assign(centres: np.ndarray):
        now = Centroids(centres, rotation)

        def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(centres), dims + 1), "int64")
            for batch in batches_of(parts):
                v, first, rest = _columns(batch)
                if len(v):
                    cluster, _, _ = now.nearest(v, first, rest)
                    order = np.argsort(cluster, kind="stable")
                    at, begin, n = np.unique(cluster[order], return_index=True, return_counts=True)
                    total[at, :dims] += np.add.reduceat(v[order], begin)
                    total[at, dims] += n
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.int64()))], ["sums"])

        def nearest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches_of(parts):
                if len(batch):
                    cluster, distance, _ = now.nearest(*_columns(batch))
                    yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster.astype("i4")), pa.array(distance)], ["id", "cluster", "distance"])

        return sums, nearest

    if len(centres):
        for _ in range(rounds):
            total = summed(stored.select("v", "lead", "rest").mapInArrow(assign(centres)[0], "sums array<bigint>")).reshape(len(centres), dims + 1)
            used = total[:, dims] > 0
            centres = np.where(used[:, None], total[:, :dims] // np.maximum(total[:, dims:], 1), centres)
    labelled = written(stored.mapInArrow(assign(centres)[1], f"id {kind}, cluster int, distance bigint"), "centroid-labels")
    discard(stored)
    release(spark)
    inertia = {r["cluster"]: r["d"] for r in labelled.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    table = [(j, c.tolist(), inertia.get(j, 0), sum(inertia.values())) for j, c in enumerate(centres)]
    clusters = spark.createDataFrame(table, "cluster int, centroid array<bigint>, cluster_inertia bigint, inertia bigint")
    return labelled.join(F.broadcast(clusters), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "centroid", "cluster_inertia", "inertia")


def start_hash(seed: int, vec_id: int) -> str:
    """The hash by which a vector is chosen as a first centroid."""
    return hashlib.sha256(f"{seed}:{vec_id}".encode()).hexdigest()
