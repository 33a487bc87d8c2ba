"""The phrase index against brute force over words, its SQL, and odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest

import __spark_entry__ as entry
from fleetspark.llm import phrases as P
from fleetspark.llm import queries
from oracle_compare import compare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, size=10, within=20):
    """By document: words, spans, items with phrases, items with near windows; all windows at all places."""
    windows = []
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        windows += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    by_length = {}
    for item, w in windows:
        by_length.setdefault(len(w), {}).setdefault(w, set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, exact, near = [False] * len(w), set(), set()
        for n, known in by_length.items():
            for i in range(len(w) - n + 1):
                if got := known.get(tuple(w[i : i + n])):
                    hit[i : i + n] = [True] * n
                    exact |= got
        stretches = [set(w[i : i + within]) for i in range(len(w))]
        for item, win in windows:
            if item not in near and len(win) <= within and any(set(win) <= s for s in stretches):
                near.add(item)
        spans = [(m.start(), m.end()) for m in re.finditer("1+", "".join("01"[h] for h in hit))]
        out.append((doc, len(w), spans, exact, near))
    return out


def got_rows(df):
    return [(r[0], r.n_words, [(s.start, s.end) for s in r.spans], {m.item_id for m in r.phrases}, {m.item_id for m in r.near}) for r in df.collect()]


def key(row):
    return str(row[0]), row[1], str(row[2]), str(sorted(map(str, row[3]))), str(sorted(map(str, row[4])))


def check(spark, docs, items, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string, shard string, term string").repartition(3)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, shard string")
    got = got_rows(P.contaminated_documents(df, asked, **options))
    want = brute([d[:2] for d in docs], [(None if i is None else str(i), t) for i, t in items], options.get("window", 10), options.get("within", 20))
    assert sorted(map(key, got)) == sorted(map(key, want))
    return want


def planted():
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "élan", "日本", "x1", "7", "the", "of"]
    draw = lambda n: [rng.choice(vocabulary) + rng.choice(["", "", "q", "z"]) for _ in range(n)]
    items = [draw(30), draw(10), draw(14), ["the"], ["of", "the", "of"], draw(22)]
    docs = []
    for k in range(60):
        text = draw(rng.randrange(0, 80))
        if k % 3 == 0:
            item = items[rng.randrange(6)]
            a = rng.randrange(len(item))
            text += item[a : a + rng.randrange(1, 25)] + draw(5)
        if k % 5 == 0:
            shuffled = items[1][:]
            rng.shuffle(shuffled)
            text += shuffled[:5] + draw(rng.randrange(12)) + shuffled[5:]
        docs.append((k, rng.choice([" ", "-", ". ", "\n"]).join(text).replace("alpha", rng.choice(["alpha", "ALPHA"])), "s", "t"))
    asked = [(i, " ".join(x)) for i, x in enumerate(items)] + [(100, None), (101, ""), (102, "!? --"), (0, " ".join(items[0])), (None, " ".join(items[5]))]
    odd = [(70, None, None, None), (71, "", "", ""), (None, " ".join(items[0]), None, None), (None, None, None, None), docs[0], docs[0], (72, "---", "s", None)]
    return docs + odd, asked


def test_phrases_and_near_matches_equal_brute_force(spark):
    docs, items = planted()
    want = check(spark, docs, items)
    assert sum(bool(w[2]) for w in want) > 10 and any(w[4] - w[3] for w in want)


@pytest.mark.parametrize("window,within", [(3, 3), (5, 40), (64, 64)])
def test_other_lengths(spark, window, within):
    docs, items = planted()
    check(spark, docs[:30], items, window=window, within=within)


def test_blocks_of_items_and_small_shards(spark):
    docs, items = planted()
    df = spark.createDataFrame(docs, "doc_id long, text string, shard string, term string").repartition(2)
    asked = spark.createDataFrame([(None if i is None else str(i), t or "") for i, t in items], "item_id string, text string").distinct()
    index = P.build_index(df, shard_bytes=700)
    assert index.postings.select("shard").distinct().count() > 4
    merged = P.search_index(index, asked, most_text=150).collect()
    single = P.search_index(index, asked).collect()
    as_set = lambda rows: sorted((r.shard, r.doc_no, str([(s.start, s.end) for s in r.spans]), str(sorted(map(str, r.phrases))), str(sorted(map(str, r.near)))) for r in rows)
    assert as_set(merged) == as_set(single) and single
    index.drop()
    with pytest.raises(ValueError):
        P.search_index(index, asked, within=P.GAP + 1)


def test_empty_tables(spark):
    docs, items = planted()
    check(spark, docs, [])
    check(spark, docs, [(1, None)])
    check(spark, [], items)


def test_very_long_text_and_word(spark):
    rng = random.Random(8)
    item = "one two three four five six seven eight nine ten eleven twelve"
    filler = " ".join(rng.choice("abcdefghij") + str(rng.randrange(5000)) for _ in range(900_000))
    text = filler + " " + item + " " + "y" * 300_000 + " " + item
    docs = spark.createDataFrame([(1, text), (2, "z" * 2_000_000), (3, item)], "doc_id long, text string")
    got = {r.doc_id: r for r in P.contaminated_documents(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()}
    assert len(text) > 5_000_000
    assert [(s.start, s.end) for s in got[1].spans] == [(900_000, 900_012), (900_013, 900_025)] and got[1].n_words == 900_025
    assert not got[2].spans and got[2].n_words == 1
    assert [(m.item_id, m.start, m.end) for m in got[3].phrases] == [("5", 0, 12)]


def test_words_with_equal_high_bits_stay_apart():
    high = np.uint64(7 << 40)
    key_ = np.array([high + 1, high + 2, high + 1, high + 2, 5], "uint64")
    assert P.by_term(key_).tolist() == [4, 0, 2, 1, 3]
    many = np.random.default_rng(1).integers(0, 50, 4000).astype("uint64") << np.uint64(50)
    assert P.by_term(many).tolist() == np.argsort(many, kind="stable").tolist()


def test_query_equals_sql_and_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    name = "op12_phrase_decontamination"
    r = compare(spark, sf, name, entry.queries()[name], entry.oracle_sql()[name])
    assert r["columns_match"] and r["values_match"], r
    read = lambda t, i: [(x[0], x[1]) for x in spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").select(i, "text").collect()]
    want = brute(read("documents", "doc_id"), [(str(i), t) for i, t in read("benchmark", "item_id")])
    digest = lambda ids: hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    expected = [(d, n, sum(b - a for a, b in spans), len(e), digest(e), bool(spans), len(near)) for d, n, spans, e, near in want]
    assert sorted(map(tuple, queries.op12_phrase_decontamination(spark, "/root/testdata/sf0.001").collect())) == sorted(expected)
