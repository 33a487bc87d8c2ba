"""SimHash groups against all pairs, the Golay keys, and components of links."""

import random
import re

import pytest
import xxhash

from fleetspark.llm import graph, queries
from fleetspark.llm.graph import components, forest
from fleetspark.llm.simhash import fingerprint, golay_table, keep_one, keys, simhash_groups

DOCS = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, most=4):
    """prints: (id, fingerprint); smallest id reachable."""
    distinct = sorted({f for _, f in prints})
    root = forest([(f, f) for f in distinct] + [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= most])
    least = {}
    for d, f in prints:
        if d is not None:
            least[root[f]] = min(d, least.get(root[f], d))
    return {(d, f): least.get(root[f]) for d, f in prints}


def test_golay_keys():
    import numpy as np

    assert np.bincount(golay_table()).tolist() == [2048] * 4096
    rng = random.Random(1)
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        row, key = keys(np.array([a, b], "uint64"))
        assert set(key[row == 0]) & set(key[row == 1])


def test_groups(spark, odd, none):
    got = simhash_groups(odd).collect()
    texts = [(r.doc_id, plain_fingerprint(r.text)) for r in odd.collect()]
    want = plain_components(texts)
    assert sorted((r.doc_id or -1, r.fp % 2**64) for r in got) == sorted((d or -1, f) for d, f in texts)
    assert all(r.component_id == want[r.doc_id, r.fp % 2**64] for r in got)
    assert simhash_groups(none).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{DOCS}/documents.parquet").collect()
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in docs])
    rows = queries.op7_simhash_dedup(spark, DOCS).collect()
    assert {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in rows} == want and len(rows) == len(docs)
    assert all(len(r.fingerprint) == 16 for r in rows) and len(set(want.values())) < len(docs)


def test_dense_fingerprints(spark, monkeypatch):
    """Chains and clouds of near fingerprints: every link counts, also through others."""
    rng = random.Random(8)
    prints = []
    for c in range(12):
        x = rng.getrandbits(64)
        for _ in range(40):
            for bit in rng.sample(range(64), rng.randint(1, 4 if c % 2 else 5)):
                x ^= 1 << bit
            prints.append(x)
    want = plain_components(list(enumerate(prints)))
    import fleetspark.llm.simhash as module

    rows = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(prints)], "doc_id long, fp long")
    monkeypatch.setattr(module, "fingerprints", lambda *a: rows)
    got = simhash_groups(rows).collect()
    assert {(r.doc_id, r.fp % 2**64): r.component_id for r in got} == want


def test_keep_one(odd):
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted(r.doc_id or -1 for r in kept.collect())
    # Of the two rows without an id the one without words has copies with ids.
    assert ids.count(-1) == 1 and ids.count(1) == 1 and 2 not in ids and 8 in ids and 9 not in ids


def test_fingerprint_of_long_and_short():
    for text in (None, "", "A", "a b c", "a b c d", "É É é " * 400):
        assert fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("few", [0, 300_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW_LINKS", few)
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(200, 400)] + [(500, x) for x in range(501, 700)] + [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(80)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = forest(pairs)
    assert got == {x: r for x, r in want.items() if any(x in p and p[0] != p[1] for p in pairs)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_by_row(spark):
    """Repeated and missing ids: every component keeps exactly one row, chosen alike in every order of the rows."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(10**6)) for _ in range(2000)) for _ in range(4)]
    near = texts[0] + " x"
    rows = [(1, texts[0], "a"), (1, texts[1], "b"), (2, texts[1], "c"), (None, texts[0], "d"), (None, texts[2], "e"), (None, texts[2], "f"), (3, near, "g"), (1, texts[0], "a"), (5, texts[3], "h"), (5, texts[3], "i")]
    for turn in range(3):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(turn + 1)
        kept = keep_one(df)
        assert kept.columns == df.columns
        got = sorted((tuple(r) for r in kept.collect()), key=str)
        assert [r[:2] for r in got] == sorted([(1, texts[0]), (1, texts[1]), (None, texts[2]), (5, texts[3])], key=str)
        assert turn == 0 or got == before
        before = got
