"""Operators that judge rows one by one, against plain Python on odd rows and on the small documents table."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetspark.llm import queries, secret_scan
from fleetspark.llm.mixing import mix_sources
from fleetspark.llm.quality_rules import STATS, keep_good, quality_rules

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stats(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_quality_statistics(spark, odd, none):
    for df in (odd, spark.read.parquet(f"{SMALL}/documents.parquet")):
        got = quality_rules(df).collect()
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        want = sorted(((r.doc_id, *stats(r.text)) for r in df.select("doc_id", "text").collect()), key=key)
        assert sorted(((r.doc_id, *[r[c] for c in STATS]) for r in got), key=key) == want
        for r in got:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.kept and r.base_failed)
    assert quality_rules(none).count() == 0


def test_quality_verdicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("toxic = 0")
    got = quality_rules(docs).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in got}
    assert share[1] > 0.95 and share[0] < 0.1


def test_keep_good_keeps_columns_and_agrees(odd):
    kept = keep_good(odd)
    assert kept.columns == odd.columns
    want = [r.doc_id for r in quality_rules(odd).filter("kept").collect()]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def all_spans(text):
    """Entropy of each window anew, flagged characters merged."""
    out = base_spans(text)
    for k, c in enumerate(secret_scan.CLASSES):
        for m in re.finditer(c.candidates, text or ""):
            if any(re.search(p, m[0]) for p in secret_scan.ALLOWED):
                continue
            last = None
            for i in range(len(m[0]) - c.window + 1):
                counts = Counter(m[0][i : i + c.window]).values()
                if -sum(n / c.window * math.log2(n / c.window) for n in counts) >= c.bits - 1e-6:
                    a, b = m.start() + i, m.start() + i + c.window
                    if last and a <= last[1]:
                        last[1] = b
                    else:
                        last = [a, b]
                        out.append((last, 3 + k))
    return sorted((x[0][0], x[1], x[0][1]) if isinstance(x[0], list) else x for x in out)


def test_secret_spans(spark, odd, none):
    kinds = [*secret_scan.BASE_KINDS, *[c.kind for c in secret_scan.CLASSES]]
    found = 0
    for df in (odd, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        texts = Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
        got = secret_scan.secret_scan(df.withColumn("other", F.col("text"))).join(df.select("doc_id", "text").distinct(), "doc_id").collect()
        assert sum(texts.values()) >= len(got) > 0
        for r in got:
            assert [tuple(x) for x in r.base] == base_spans(r.text), r.doc_id
            assert [tuple(x) for x in r.spans] == all_spans(r.text), r.doc_id
            found += len(r.spans) > len(r.base)
    assert found > 0 and kinds[0] == "assign"
    assert secret_scan.secret_scan(none).count() == 0


def test_secret_digest(spark):
    rows = queries.op3_secret_scan(spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = base_spans(texts[r.doc_id])
        joined = ",".join(f"{secret_scan.BASE_KINDS[o]}:{s}:{e}" for s, o, e in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(o == k for _, o, _ in want) for k in range(3)]


def test_redact(odd):
    out = secret_scan.redact(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    before = {r.doc_id: r.text for r in odd.collect()}
    assert texts[10].startswith('<secret>" <secret> 𝒳 token = ab <secret>')
    assert "k3Jx9" not in texts[15] and texts[1] == before[1] and texts[4] is None and texts[5] == ""


def reshared(sizes: dict, weights, share, most) -> dict:
    """Targets by sharing out and resharing, as told."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = dict.fromkeys(order, 0.0), set(order), share * sum(sizes.values())
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(free):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                free.discard(s)
    return target


@pytest.mark.parametrize("weights", [(3, 1, 2), (50, 1, 1)])
def test_mix(spark, odd, none, weights):
    for df in (odd, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        rows = mix_sources(df, weights).collect()
        assert len(rows) == df.count()
        source = {r.doc_id: r.source for r in df.collect()}
        sizes, largest, taken = Counter(), Counter(), Counter()
        for r in df.collect():
            n = len(WORD.findall(r.text or ""))
            sizes[r.source] += n
            largest[r.source] = max(largest[r.source], n)
        want = reshared(sizes, weights, 1.5, 2)
        for r in rows:
            s = source[r.doc_id]
            assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
            assert r.taken in (0, r.size, 2 * r.size)
            taken[s] += r.taken
        for s in sizes:
            assert abs(taken[s] - want[s]) <= max(largest[s] * 2, 1)
        again = mix_sources(df.repartition(5), weights).collect()
        key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
        assert sorted(rows, key=key) == sorted(again, key=key)
    assert mix_sources(none).count() == 0


def test_mix_query_matches_sql(spark):
    from oracle_compare import compare

    r = compare(spark, "/root/testdata/sf0.01", "op4_mix_sources", queries.op4_mix_sources, queries.ORACLE["op4_mix_sources"])
    assert r["columns_match"] and r["spark_rows"] == r["oracle_rows"] and r["values_match"], r


def test_very_many_secrets_in_one_text(spark):
    """A text of 30,000 keys is located by blocks; offsets equal the regular expression's."""
    keys = [f"AKIA{n:016d}" if n % 3 else f"token={n:06d}é" for n in range(30_000)]
    text = "é ".join(keys)
    df = spark.createDataFrame([(1, text), (2, None), (3, "x " * 200_000)], "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.base] for r in secret_scan.secret_scan(df).collect()}
    assert got == {1: base_spans(text), 2: [], 3: []} and len(got[1]) > 19_000
