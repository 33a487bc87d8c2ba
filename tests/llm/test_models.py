"""Neighbour search by recall against brute force; the classifier by held-out grades."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetspark.llm import queries
from fleetspark.llm.neighbours import Search, nearest_neighbours
from fleetspark.llm.ordinal import fit_ordinal, grade_documents, train

DOCS = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


def exact(ids, vectors, query, k):
    scores = vectors.astype("f8") @ vectors[query].astype("f8")
    order = [i for i in np.lexsort((ids, -scores)) if i != query][:k]
    return [(int(ids[i]), scores[i]) for i in order]


def test_neighbour_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], "f4")
    got = {}
    for r in queries.op6_collision_neighbours(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, []).append(r)
    assert sorted(got) == sorted(i for i in ids.tolist() if i % 20 == 0)
    hits = 0
    for q, found in got.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 21))
        want = exact(ids, vectors, int(np.flatnonzero(ids == q)[0]), 20)
        hits += len({r.vec_id for r in found} & {i for i, _ in want})
        scores = {i: float(vectors[np.flatnonzero(ids == i)[0]].astype("f8") @ vectors[np.flatnonzero(ids == q)[0]].astype("f8")) for i in [r.vec_id for r in found]}
        assert all(abs(r.score - scores[r.vec_id]) < 1e-12 for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
    assert hits >= 0.93 * 20 * len(got)


def test_neighbours_in_shards_with_copies(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 8)).astype("f4") * rng.uniform(0.5, 2, (300, 1)).astype("f4")
    rows = [(i, base[i].tolist()) for i in range(300)] + [(1000 + i, base[0].tolist()) for i in range(200)]
    odd = [(5001, None), (5002, []), (5003, [0.0] * 8), (5004, [NAN] + [1.0] * 7), (5005, [INF] + [1.0] * 7), (5006, [None] + [1.0] * 7), (5007, [1.0] * 5), (None, [1.0] * 8), (5, base[5].tolist())]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, score string").repartition(4)
    search = Search(shard=64, block=16, verified=1.0)
    got = {}
    for r in nearest_neighbours(df, F.col("vec_id") % 20 == 0, 20, search).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], "f4")
    assert sorted(got) == [i for i, _ in rows if i % 20 == 0]
    for q, found in got.items():
        want = exact(ids, vectors, int(np.flatnonzero(ids == q)[0]), 20)
        assert [i for _, i, _ in sorted(found)] == [i for i, _ in want]
        assert [s for *_, s in sorted(found)] == pytest.approx([s for _, s in want], abs=1e-12)
    few = nearest_neighbours(df.filter("vec_id in (0, 1, 2)"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert nearest_neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_thresholds_are_ordered():
    rng = np.random.default_rng(2)
    x = rng.uniform(0, 1, 400)
    grades = np.digitize(x + rng.normal(0, 0.05, 400), [0.25, 0.5, 0.75])
    rows = [(np.array([7, 8]), np.array([v, 1.0])) for v in x]
    model = fit_ordinal(rows, grades, 4, rounds=400)
    assert (np.diff(model.thresholds) > 0).all()
    score = np.array([(model.weights[b] * v).sum() for b, v in rows])
    assert np.corrcoef(model.above(score).sum(axis=1), grades)[0, 1] > 0.9


def test_held_out_grades(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1).alias("grade"))
    model = train(docs, labels.filter("doc_id % 3 > 0"), 3)
    held = grade_documents(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    mean = {g: np.mean([r.expected_grade for r in held if r.grade == g]) for g in (0, 1, 2)}
    assert mean[0] < mean[1] < mean[2]
    assert np.mean([r.expected_grade >= 1.2 for r in held if r.grade == 2]) > 0.94
    assert np.mean([r.expected_grade < 1.2 for r in held if r.grade == 0]) > 0.7
    assert all(0 <= r.tail_probability <= r.expected_grade <= 2 for r in held)


def test_odd_documents(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 1), (None, 1), (7, None), (99, 1), (1, 1)], "doc_id long, grade int")
    model = train(odd, labels, 2)
    rows = grade_documents(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.expected_grade <= 1 for r in rows)
    empty = train(odd, labels.limit(0), 3)
    assert {round(r.expected_grade, 6) for r in grade_documents(odd, empty).collect()} == {1.0}
    assert grade_documents(none, model).count() == 0


def test_fit_follows_the_plain_gradient():
    """The first steps of the fit equal Adam on finite differences of the stated likelihood, written out row by row."""
    from fleetspark.llm.ordinal import BUCKETS, FORM

    rng = np.random.default_rng(5)
    x = rng.uniform(-1, 1, (40, 2))
    grades = np.digitize(x[:, 0] + rng.normal(0, 0.3, 40), [-0.4, 0.3])
    rows = [(np.array([3, 9]), v) for v in x]
    size = np.bincount(grades, minlength=3)
    weight = [float(np.sqrt(40 / size[g] / 3)) / 40 for g in grades]

    def loss(z):
        w, cuts = z[:2], [z[2], z[2] + np.exp(z[3])]
        total = 2e-4 / 2 * (w[0] ** 2 + w[1] ** 2)
        for v, g, m in zip(x, grades, weight, strict=True):
            above = [1.0, *[1 / (1 + np.exp(-(float(v @ w) - c))) for c in cuts], 0.0]
            total -= m * np.log(above[g] - above[g + 1])
        return total

    z, a, b = np.array([0.0, 0.0, -1.0, 0.5]), np.zeros(4), np.zeros(4)
    for step in range(1, 16):
        g = np.array([(loss(z + e) - loss(z - e)) / 2e-6 for e in np.eye(4) * 1e-6])
        a, b = 0.9 * a + 0.1 * g, 0.999 * b + 0.001 * g**2
        z = z - 0.1 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-10)
    model = fit_ordinal(rows, grades, 3, rounds=15)
    assert np.allclose(model.weights[[3, 9]], z[:2], atol=1e-4) and np.count_nonzero(model.weights) == 2 and len(model.weights) == BUCKETS + FORM
    assert np.allclose(model.thresholds, [z[2], z[2] + np.exp(z[3])], atol=1e-4)


def test_scores_equal_plain_sums(spark, odd):
    from fleetspark.llm.ordinal import features

    labels = spark.createDataFrame([(i, i % 3) for i in range(1, 18)], "doc_id long, grade int")
    model = train(odd, labels, 3)
    want = []
    for r in odd.select("doc_id", "text").collect():
        buckets, values = features((r.text or "").encode())
        score = sum(float(np.float32(model.weights[b])) * float(v) for b, v in zip(buckets, values, strict=True)) if len(buckets) > 1 else 0.0
        above = [1 / (1 + np.exp(-(score - c))) for c in model.thresholds]
        want.append((str(r.doc_id), sum(above), above[-1]))
    got = sorted((str(r.doc_id), r.expected_grade, r.tail_probability) for r in grade_documents(odd, model).collect())
    for g, w in zip(got, sorted(want), strict=True):
        assert g[0] == w[0] and abs(g[1] - w[1]) < 1e-4 and abs(g[2] - w[2]) < 1e-4


def test_label_model_equals_plain_em(spark):
    """Expectation-maximisation written out with loops, on random counted patterns."""
    from fleetspark.llm.quality_rules import fit

    rng = np.random.default_rng(8)
    votes = [tuple(int(v) for v in rng.integers(-1, 2, 4)) for _ in range(30)]
    patterns = [(*v, int(n)) for v, n in zip(dict.fromkeys(votes), rng.integers(1, 400, len(set(votes))), strict=True)]
    prior, p, q = 0.8, [0.95] * 4, [0.6] * 4
    bound = lambda x, lo, hi: max(lo, min(hi, x))
    for _ in range(25):
        good = []
        for *v, n in patterns:
            logit = np.log(prior / (1 - prior)) + sum(np.log(p[j] / (1 - q[j])) if x == 1 else np.log((1 - p[j]) / q[j]) if x == -1 else 0 for j, x in enumerate(v))
            good.append(n / (1 + np.exp(-logit)))
        bad = [x[-1] - g for x, g in zip(patterns, good, strict=True)]
        prior = bound((sum(good) + 0.8 * 50) / (sum(x[-1] for x in patterns) + 50), 0.05, 0.95)
        for j in range(4):
            of = lambda xs, vs: sum(x for x, v in zip(xs, patterns, strict=True) if v[j] in vs)
            p[j] = bound((of(good, (1,)) + 0.95 * 50) / (of(good, (1, -1)) + 50), 0.55, 0.99)
            q[j] = bound((of(bad, (-1,)) + 0.6 * 50) / (of(bad, (1, -1)) + 50), 0.05, 0.99)
    df = spark.createDataFrame(patterns, "v0 int, v1 int, v2 int, v3 int, n long")
    model = fit(df, 4)
    assert np.allclose([model.prior, *model.right_good, *model.right_bad], [prior, *p, *q], atol=1e-9)
    columns = [F.col(f"v{j}") for j in range(4)]
    for r in df.withColumn("x", model.posterior(columns)).collect():
        logit = np.log(prior / (1 - prior)) + sum(np.log(p[j] / (1 - q[j])) if r[j] == 1 else np.log((1 - p[j]) / q[j]) if r[j] == -1 else 0 for j in range(4))
        assert abs(r.x - 1 / (1 + np.exp(-logit))) < 1e-9
