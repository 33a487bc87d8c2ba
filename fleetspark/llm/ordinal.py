"""Quality classifier: cumulative-link regression on graded ratings.

Texts become hashed features: which words occur, in a fixed number of buckets,
and a few figures on form. Buckets of words that few rated texts have get no
weight, as they would only tell single texts apart. One weight vector gives a score;
ordered thresholds cut it into grades: P(grade > j) = sigmoid(score - t_j). The
gaps between thresholds are exponentials, so they stay ordered. The expected
grade and the tail probability of the best grade come from these.

The model is fitted on a bounded sample of labelled rows (``most_rows``, chosen
by a hash of the id, so reruns agree); it scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import text_or_empty
from fleetspark.llm.suffix_dedup import Hashes, mixed

BUCKETS = 1 << 18
#: Labelled rows that the fit reads at most (about; whole texts); least number and share of them that must have a word.
MOST_ROWS = 12_000
LEAST_TEXTS, LEAST_SHARE = 5, 0.002
FORM = 6
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
CLASSES = [np.isin(np.arange(256), np.frombuffer(x, "u1")) for x in (b"#*$%&|<>", b"!?", b".,;:", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")]
_hashes: list[Hashes] = []


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and values of a text: 1 for each word that occurs, and shares of kinds of characters."""
    data = np.frombuffer(text, "u1")
    lower = np.where((data >= 65) & (data <= 90), data + 32, data)
    letter = ~SPACE[data] & ~CLASSES[0][data] & ~CLASSES[1][data] & ~CLASSES[2][data]
    start = np.flatnonzero(letter & np.concatenate([[True], ~letter[:-1]]))
    end = np.flatnonzero(letter & np.concatenate([~letter[1:], [True]])) + 1
    if not len(start):
        return np.array([BUCKETS], "int64"), np.ones(1)
    if not _hashes or len(_hashes[0].power) <= len(data):
        _hashes[:] = [Hashes(31, max(len(data), 1 << 17))]
    h = _hashes[0]
    sums = h.sums(lower)
    word = mixed((sums[end] - sums[start]) * h.inverse[start])
    buckets = np.unique(word % np.uint64(BUCKETS))
    values = np.ones(len(buckets))
    share = np.array([c[data].sum() / len(start) for c in CLASSES])
    form = np.concatenate([[1.0], np.minimum(share, 2.0)])
    return np.concatenate([buckets.astype("int64"), BUCKETS + np.arange(FORM)]), np.concatenate([values, form])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    """Weights per bucket and thresholds in ascending order; grades are 0 to len(thresholds)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > j) for each score and threshold."""
        return _sigmoid(scores[:, None] - self.thresholds)


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, rounds: int = 120, penalty: float = 2e-4, rate: float = 0.1) -> OrdinalModel:
    """Maximum likelihood by Adam on the whole sample; rare grades weigh more (by the root of their share)."""
    of = np.repeat(np.arange(len(rows)), [len(b) for b, _ in rows])
    buckets, values = np.concatenate([b for b, _ in rows]), np.concatenate([v for _, v in rows])
    texts_with = np.bincount(buckets[values != 0], minlength=BUCKETS + FORM)
    used = texts_with >= max(LEAST_TEXTS, LEAST_SHARE * len(rows))
    values = values * used[buckets]
    size = np.bincount(grades, minlength=n_grades)
    weight = np.sqrt(len(grades) / np.maximum(size, 1) / max((size > 0).sum(), 1))[grades] / len(grades)
    w, t = np.zeros(BUCKETS + FORM), np.concatenate([[-1.0], np.full(n_grades - 2, 0.5)])
    moments = [np.zeros_like(x) for x in (w, w, t, t)]
    for step in range(1, rounds + 1):
        cuts = np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))
        score = np.bincount(of, values * w[buckets], minlength=len(rows))
        above = np.concatenate([np.ones((len(rows), 1)), _sigmoid(score[:, None] - cuts), np.zeros((len(rows), 1))], axis=1)
        here = np.arange(len(rows))
        hi, lo = above[here, grades], above[here, grades + 1]
        like = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = hi * (1 - hi) / like, lo * (1 - lo) / like
        g_score = -(d_hi - d_lo) * weight
        g_w = np.bincount(buckets, g_score[of] * values, minlength=len(w)) + penalty * w
        g_cut = np.zeros(n_grades + 1)
        np.add.at(g_cut, grades, d_hi * weight)
        np.add.at(g_cut, grades + 1, -d_lo * weight)
        inner = g_cut[1:n_grades]
        tail = np.cumsum(inner[::-1])[::-1]
        g_t = np.concatenate([tail[:1], tail[1:] * np.exp(t[1:])])
        for x, g, at in ((w, g_w, 0), (t, g_t, 2)):
            moments[at] = 0.9 * moments[at] + 0.1 * g
            moments[at + 1] = 0.999 * moments[at + 1] + 0.001 * g**2
            x -= rate * (moments[at] / (1 - 0.9**step)) / (np.sqrt(moments[at + 1] / (1 - 0.999**step)) + 1e-10)
    return OrdinalModel(w, np.cumsum(np.concatenate([t[:1], np.exp(t[1:])])))


def train(docs: DataFrame, grades: DataFrame, n_grades: int, most_rows: int = MOST_ROWS, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade") -> OrdinalModel:
    """Fits on at most about ``most_rows`` labelled documents, which only leave the executors as features.

    Defined cases: null texts are empty; null grades and grades of no document
    are ignored, repeated ones count each; without labelled rows every grade
    is equally likely.
    """
    spark = docs.sparkSession
    graded = grades.select(F.col(id_col).alias("doc_id"), F.col(grade_col).cast("int").alias("grade")).filter(F.col("doc_id").isNotNull() & F.col("grade").between(0, n_grades - 1))
    total = graded.count()
    if total > most_rows:
        # About most_rows are left, which is what bounds the broadcast below.
        graded = graded.filter(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) < int(most_rows / total * (1 << 30)))
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).join(F.broadcast(graded), "doc_id").select("doc_id", "text", "grade")

    def extract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            got = [features(x) for x in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("grade").cast(pa.int32()), pa.array([b.astype("<i4").tobytes() for b, _ in got], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in got], pa.binary())],
                ["doc_id", "grade", "buckets", "values"],
            )

    rows = texts.mapInArrow(extract, "doc_id bigint, grade int, buckets binary, values binary").collect()
    if not rows:
        return OrdinalModel(np.zeros(BUCKETS + FORM), np.log(np.arange(1, n_grades) / (n_grades - np.arange(1, n_grades))))
    rows.sort(key=lambda r: (r.doc_id, r.grade, bytes(r.buckets)))
    sample = [(np.frombuffer(r.buckets, "<i4").astype("int64"), np.frombuffer(r["values"], "<f4").astype("float64")) for r in rows]
    return fit_ordinal(sample, np.array([r.grade for r in rows]), n_grades)


def grade_documents(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, expected_grade and tail_probability (of the best grade), each from the whole text.

    Defined cases: null and empty texts are scored by the thresholds alone;
    repeated rows each get their row; a null id stays null; an empty table
    gives no rows; other columns are ignored.
    """
    picked = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    weights, thresholds = model.weights.astype("float32"), model.thresholds

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            scores = []
            for x in batch.column("text").cast(pa.binary()):
                buckets, values = features(x.as_py())
                scores.append(float((weights[buckets] * values).sum()) if len(buckets) > 1 else 0.0)
            above = OrdinalModel(weights, thresholds).above(np.array(scores).reshape(-1))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.round(above.sum(axis=1), 9)), pa.array(np.round(above[:, -1], 9))], ["doc_id", "expected_grade", "tail_probability"])

    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(score, f"doc_id {kind}, expected_grade double, tail_probability double").withColumnRenamed("doc_id", id_col)
