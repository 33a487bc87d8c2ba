"""Centroid clusters and vector codes against brute force over all pairs, their SQL, and odd rows."""

import hashlib
import math

import numpy as np
import pytest

import __spark_entry__ as entry
from fleetspark.llm import centroids as C
from fleetspark.llm import vector_codes as V
from oracle_compare import compare

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, lead string, rest string, chunk string, part string, id string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def floors(vectors, scale):
    return np.array([[math.floor(scale * x) for x in v] for v in vectors], "int64")


def all_pairs(points, centres):
    d = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


def moved(points, centres, assigned):
    return np.array([[sum(col) // int((assigned == j).sum()) for col in points[assigned == j].T.tolist()] if (assigned == j).any() else c for j, c in enumerate(centres.tolist())], "int64")


def clusters(rows, k=8, rounds=10, dims=64):
    rows = sorted((r for r in rows if r[1] is not None and len(r[1]) == dims and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    if not rows:
        return []
    points = floors([r[1] for r in rows], 1024)
    centres = points[:k].copy()
    for _ in range(rounds):
        centres = moved(points, centres, all_pairs(points, centres)[0])
    to, d = all_pairs(points, centres)
    return [(r[0], int(j), int(x), centres[j].tolist(), int(d[to == j].sum()), int(d.sum())) for r, j, x in zip(rows, to, d, strict=True)]


def codes(rows, parts=16, entries=64, rounds=2):
    rows = sorted((r for r in rows if r[1] and len(r[1]) == 64 and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not rows:
        return [], []
    points = floors([r[1] for r in rows], 256).reshape(len(rows), parts, -1)
    books = points[:entries].transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = np.array([moved(points[:, p], books[p], all_pairs(points[:, p], books[p])[0]) for p in range(parts)])
    found = [all_pairs(points[:, p], books[p]) for p in range(parts)]
    code, error = np.stack([f[0] for f in found], axis=1), sum(f[1] for f in found)
    total = {}
    for r, e in zip(rows, error.tolist(), strict=True):
        total[r[2]] = total.get(r[2], 0) + e
    return [(r[0], r[2], c, e, total[r[2]]) for r, c, e in zip(rows, code.tolist(), error.tolist(), strict=True)], books.tolist()


def vectors(n=400, spread=0.1):
    rng = np.random.default_rng(6)
    means = rng.standard_normal((6, 64)) * 0.3
    return [(i, (means[i % 6] + spread * rng.standard_normal(64)).tolist(), i % 5 or None) for i in range(n)]


def odd():
    """Ties, copies (a third of all rows), repeated rows and ids, nulls, other dimensions, numbers that are not finite, large and zero vectors."""
    rows = vectors()
    rows += [(1000 + i, rows[7][1], 3) for i in range(200)] + [rows[3], rows[3], (5, rows[9][1], 1), (None, rows[11][1], None), (None, rows[12][1], 2)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 64, 1), (2003, [NAN] + [0.1] * 63, 1), (2004, [INF] * 64, 1), (2005, [None] + [0.1] * 63, 1), (2006, [0.5] * 63, 1), (2007, [0.5] * 128, 1)]
    return rows + [(2008, [1000.5] + [-0.25] * 63, 7), (2009, [-0.0001] * 64, 7), (2010, [1e-300] * 64, 8), (None, None, None)]


def rows_of(found):
    return [tuple(r) for r in found.collect()]


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_clusters_equal_brute_force(spark):
    want = clusters(odd())
    same(rows_of(C.cluster_vectors(frame(spark, odd()))), want)
    assert len({w[1] for w in want}) > 2


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], vectors(3), [(i, [0.5] * 64, 1) for i in range(20)], [(i, [(-1.0) ** i] * 64, None) for i in range(30)]])
def test_few_equal_and_no_vectors(spark, rows):
    same(rows_of(C.cluster_vectors(frame(spark, rows))), clusters(rows))
    found, books = V.compress_vectors(frame(spark, rows))
    want, want_books = codes(rows)
    same(rows_of(found), want)
    assert not want or books.tolist() == want_books


def test_codes_equal_brute_force(spark):
    want, want_books = codes(odd())
    for options in ({}, {"chunk": 64, "block": 8}, {"most_labels": 2}):
        found, books = V.compress_vectors(frame(spark, odd()), **options)
        same(rows_of(found), want)
        assert books.tolist() == want_books


def test_vectors_too_long_for_whole_distances_are_an_error(spark):
    rows = vectors(10) + [(99, [1e30] * 64, 1)]
    for run in (C.cluster_vectors, lambda df: V.compress_vectors(df)[0]):
        with pytest.raises(Exception, match="must not be longer"):
            run(frame(spark, rows)).collect()


def test_dimension_that_parts_do_not_divide(spark):
    found, books = V.compress_vectors(frame(spark, [(i, [0.1 * i] * 10, 1) for i in range(5)]))
    assert not found.collect() and not books.size


def test_bounds_leave_few_centroids_and_never_the_nearest():
    points = floors([v for _, v, _ in vectors(600, 0.02)], 1024)
    centres = points[:8]
    rotation = C.Rotation(np.linalg.qr(np.random.default_rng(1).standard_normal((64, 64)))[0], 16)
    cov = np.linalg.eigh(np.cov(points.T))[1][:, ::-1].T
    for turn in (rotation, C.Rotation(np.ascontiguousarray(cov), 16)):
        to, d, looked = C.Centroids(centres, turn).nearest(points, *turn.split(points.astype("f8")))
        want = all_pairs(points, centres)
        assert (to == want[0]).all() and (d == want[1]).all()
    assert looked < 0.4 * len(points) * 8


def test_boxes_never_drop_the_nearest_entry():
    rng = np.random.default_rng(2)
    points = rng.integers(-90, 90, (1280, 4))
    order = V.curve_order(points)
    books = rng.integers(-90, 90, (64, 4))
    books[5] = books[60]
    left = 0
    for at in range(0, len(order), 16):
        block = points[order[at : at + 16]]
        keep = np.flatnonzero(V.shortlist(block.min(axis=0)[None], block.max(axis=0)[None], books)[0])
        left += len(keep)
        best, d = V.kernel(block, books[keep])
        want = all_pairs(block, books)
        assert (keep[best] == want[0]).all() and (d == want[1]).all()
    assert left < 0.7 * 64 * 80


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_each_point_once_by_single_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    keys = V.hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("name", ["op11_centroid_clusters", "op13_vector_codes"])
def test_queries_equal_sql(spark, name):
    r = compare(spark, "/root/testdata/sf0.01", name, entry.queries()[name], entry.oracle_sql()[name])
    assert r["columns_match"] and r["values_match"], r
