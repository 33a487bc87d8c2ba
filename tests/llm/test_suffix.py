"""Repeated strings against a dictionary of all windows."""

import hashlib

import numpy as np
import pytest

from fleetspark.llm import queries
from fleetspark.llm.suffix_dedup import cut_repeats, least_places


def plain(rows, length):
    """rows: (id, bytes) with different ids; removed mask per id."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            w = text[i : i + length]
            if w in seen:
                gone[i : i + length] = True
            seen.add(w)
        out[d] = gone
    return out


def spans_of(gone):
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
    return [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def test_least_places():
    rng = np.random.default_rng(2)
    grams = rng.integers(0, 1 << 64, 400, dtype="uint64")
    grams[100:200] = grams[100]
    for width in (1, 2, 7, 69):
        top = grams >> np.uint64(9)
        assert least_places(grams, width).tolist() == [i + int(np.argmin(top[i : i + width])) for i in range(len(grams) - width + 1)]


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    want = plain([(r.doc_id, (r.text or "").encode()) for r in docs], 100)
    texts = {r.doc_id: (r.text or "").encode() for r in docs}
    rows = queries.op5_suffix_dedup(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        gone = want[r.doc_id]
        kept = bytes(np.frombuffer(texts[r.doc_id], "u1")[~gone])
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(gone), int(gone.sum()), len(spans_of(gone))), r.doc_id
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert sum(r.n_removed for r in rows) > 0


def test_odd_rows(spark, odd, none):
    rows = cut_repeats(odd, length=50, gram=16).collect()
    assert len(rows) == odd.count()
    named = {}
    for r in odd.collect():
        named[1 << 62 if r.doc_id is None else r.doc_id, r.text] = (r.text or "").encode()
    merged = [(d, x) for (d, _), x in named.items() if d < 1 << 62]
    want = plain(merged, 50)
    for r in rows:
        if r.doc_id is not None:
            assert [(s.start, s.end) for s in r.spans] == spans_of(want[r.doc_id]), r.doc_id
            assert bytes(r.kept) == bytes(np.frombuffer(dict(merged)[r.doc_id], "u1")[~want[r.doc_id]])
    assert cut_repeats(none).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_mixed_copies(spark, seed):
    """Few letters, copies at all offsets, runs of one byte, overlaps within a text."""
    rng = np.random.default_rng(seed)
    pool = [bytes(rng.choice(list(b"ab "), 300)) for _ in range(4)] + [b"z" * 400, b"xy" * 150]
    rows = []
    for d in range(60):
        text = b""
        for _ in range(rng.integers(0, 4)):
            piece = pool[rng.integers(len(pool))]
            a = int(rng.integers(0, 200))
            text += piece[a : a + int(rng.integers(20, 200))] + bytes(rng.choice(list(b"cdefgh"), rng.integers(0, 30)))
        rows.append((d, text.decode()))
    want = plain([(d, t.encode()) for d, t in rows], 60)
    got = cut_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), length=60, gram=16).collect()
    for r in got:
        assert [(s.start, s.end) for s in r.spans] == spans_of(want[r.doc_id]), r.doc_id
