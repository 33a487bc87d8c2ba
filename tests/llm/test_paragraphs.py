"""Repeated paragraphs against all pairs, passages inside paragraphs, clean documents."""

import random

from fleetspark.llm import queries
from fleetspark.llm.graph import forest
from fleetspark.llm.paragraphs import PARAGRAPH, repeated_paragraphs

DOCS = "/root/testdata/sf0.01"


def lines_of(text):
    """(first word, words) of each line of a text, ASCII lower case."""
    at, out = 0, []
    for line in (text or "").encode().lower().split(b"\n"):
        words = line.split()
        if len(words) >= PARAGRAPH:
            out.append((at, tuple(words)))
        at += len(words)
    return out


def shingles(words):
    return {words[i : i + 5] for i in range(len(words) - 4)}


def classes(lines, similarity=0.8):
    distinct = sorted(set(lines))
    sets, holders, pairs = [shingles(x) for x in distinct], {}, set()
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for hs in holders.values():
        pairs.update((a, b) for a in hs[:50] for b in hs if a < b)
    linked = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    root = forest(linked)
    return {x: root.get(i, i) for i, x in enumerate(distinct)}


def test_paragraphs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DOCS}/documents.parquet").collect()}
    place = {(d, a): words for d, t in docs.items() for a, words in lines_of(t)}
    of = classes(list(place.values()))
    members = {}
    for at, words in place.items():
        members.setdefault(of[words], []).append(at)
    want = {at: (min(ms), len(ms)) for ms in members.values() if len(ms) > 1 for at in ms}
    rows = [r for r in queries.op2_paragraph_dedup(spark, DOCS).collect() if r.kind == "paragraph"]
    got = {(r.doc_id, r.first_word): r for r in rows}
    assert len(got) == len(rows) and set(got) <= set(want)
    assert len(got) >= 0.99 * len(want) and len(want) > 100
    for at, r in got.items():
        if r.n_same == want[at][1]:
            assert r.first_doc_id == want[at][0][0] and r.removed == (at != want[at][0])
            assert r.end_word - r.first_word == len(place[at])


def test_planted_passages(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(51, 80)) for _ in range(60)]
    rows, held = [], {}
    for d in range(400):
        text = prose(rng.randint(20, 200))
        if d % 2:
            p = rng.randrange(len(passages))
            held.setdefault(p, []).append(d)
            text += " " + passages[p].upper() + rng.choice([" ", "\n"]) + prose(rng.randint(5, 90))
        rows.append((d, text + "\nsome licence line of less words than a passage needs to count"))
    got = repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    planted = {d for ds in held.values() if len(ds) > 1 for d in ds}
    found = {r.doc_id for r in got}
    assert found <= planted and len(found) >= 0.97 * len(planted)
    first = {d: ds[0] for ds in held.values() for d in ds}
    assert all(r.first_id == first[r.doc_id] and r.removed == (r.doc_id != first[r.doc_id]) for r in got)


def test_near_paragraphs(spark):
    rng = random.Random(9)
    rows = []
    for g in range(40):
        words = [f"w{rng.randrange(500)}" for _ in range(100)]
        for v in range(3):
            w = list(words)
            if v:
                w[rng.randrange(100)] = f"x{g}{v}"
            rows.append((3 * g + v, " ".join(w)))
    got = [r for r in repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.kind == "paragraph"]
    assert len(got) >= 117 and all(r.first_id == r.doc_id // 3 * 3 for r in got if r.n_same == 3)


def test_odd_rows(odd, none):
    got = repeated_paragraphs(odd).collect()
    ids = {r.doc_id for r in got}
    assert {1, 2, 3, 8, 9, 14} <= ids and not ids & {4, 5, 6, 7, 12, None}
    assert repeated_paragraphs(none).count() == 0


def test_one_copy_stays(spark):
    """A phrase that stands earlier, beside or inside a passage, never takes the passage's first occurrence with it."""
    rng = random.Random(16)
    prose = lambda n: " ".join(f"{rng.choice('bcdfg')}{rng.randrange(100000)}" for _ in range(n))
    rows, passages = [], []
    for g in range(60):
        phrase, before, after = prose(rng.choice([8, 12, 25])), prose(30), prose(30)
        passage = [f"{phrase} {before} {after}", f"{before} {phrase} {after}", f"{before} {after} {phrase}"][g % 3]
        rows.append((4 * g, f"{prose(40)} {phrase} {prose(40)}"))
        rows += [(4 * g + k, f"{prose(40)} {passage} {prose(40)}") for k in (1, 2, 3)]
        passages.append((before, after))
    got = repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    words = {d: t.split() for d, t in rows}
    gone = {d: set() for d in words}
    for r in got:
        gone[r.doc_id].update(range(r.first_word, r.end_word) if r.removed else ())
    for g, parts in enumerate(passages):
        for part in parts:
            part = part.split()
            at = {k: words[4 * g + k].index(part[0]) for k in (1, 2, 3)}
            assert not gone[4 * g + 1] & set(range(at[1], at[1] + len(part)))
            assert all(len(gone[4 * g + k] & set(range(at[k], at[k] + len(part)))) >= 1 for k in (2, 3))
        first = {r.first_id for r in got if r.doc_id in (4 * g + 2, 4 * g + 3)}
        assert first <= {4 * g, 4 * g + 1} and 4 * g + 1 in first


def test_passages_over_short_lines(spark):
    """Passages over lines of 5 to 18 words, broken anew in every copy, are found whole, to the word."""
    rng = random.Random(21)
    prose = lambda n: [f"{rng.choice('bcdfg')}{rng.randrange(100000)}" for _ in range(n)]

    def lines(words, least, most):
        out = []
        while words:
            n = rng.randint(least, most)
            out, words = [*out, " ".join(words[:n])], words[n:]
        return "\n".join(out)

    rows, want = [], {}
    for g in range(120):
        least, most = ((5, 8), (8, 12), (10, 14), (14, 18))[g % 4]
        passage = prose(rng.randint(29, 90))
        for k in range(3):
            head = prose(rng.randint(0, 60))
            rows.append((3 * g + k, lines(head + passage + prose(rng.randint(0, 60)), least, most)))
            want[3 * g + k] = (len(head), len(head) + len(passage), 3 * g, k > 0)
    got = repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.first_word, r.end_word, r.first_id, r.removed) for r in got if r.kind == "passage"} == want
    assert len(got) == len(want)


def test_short_paragraphs(spark, tmp_path):
    """The query judges lines of every length: exact copies from one word on, near copies of 13 to 19 words."""
    rng = random.Random(33)
    prose = lambda n: [f"{rng.choice('bcdfg')}{rng.randrange(100000)}" for _ in range(n)]
    rows, want = [], {}
    for g in range(100):
        n = g % 19 + 1
        line = prose(n)
        for k in range(3):
            same = [*line[:-1], f"x{g}{k}"] if n >= 13 and k else line
            rows.append((3 * g + k, " ".join(prose(25)) + "\n" + " ".join(same)))
            want[3 * g + k] = (25, 25 + n, 3 * g, k > 0, 3)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [r for r in queries.op2_paragraph_dedup(spark, str(tmp_path)).collect() if r.kind == "paragraph"]
    found = {r.doc_id: (r.first_word, r.end_word, r.first_doc_id, r.removed, r.n_same) for r in got}
    assert len(found) == len(got) >= 0.98 * len(want) and set(found) <= set(want)
    exact = {d: x for d, x in want.items() if x[1] - x[0] < 13}
    assert {d: found.get(d) for d in exact} == exact
    assert all(x[:2] == want[d][:2] and (x[4] < 3 or x == want[d]) for d, x in found.items())


def test_self_repeating_text_is_one_row(spark):
    """A text of one word, or of a short cycle of words, is one removed run; of twins the later one goes whole."""
    rng = random.Random(4)
    cycle = " ".join(f"c{rng.randrange(1000)}" for _ in range(7))
    texts = ["for " * 3000, " ".join([cycle] * 400), " ".join(["a b", cycle] * 200), " ".join([cycle] * 400) + " tail"]
    got = [r for r in repeated_paragraphs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect() if r.kind == "passage"]
    gone = {d: [(r.first_word, r.end_word) for r in got if r.doc_id == d and r.removed] for d in range(4)}
    assert all(len(x) <= 2 for x in gone.values()) and len(got) <= 12
    assert gone[0] == [(1, 3000)] and gone[1][0][0] < 7 + 16 and gone[1][0][1] == 2800
    assert gone[3][0][1] == 2800 and gone[3][0][0] == 0


def test_work_tables_drop_the_shuffle_files_of_their_jobs(spark):
    import time
    from pathlib import Path

    from fleetspark.llm import common, paragraphs

    dirs = [Path(d.toString()) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in dirs for f in d.rglob("shuffle_*.data")}
    before, setting = files(), spark.conf.get(common.DROP_SHUFFLES)
    rows = spark.range(5000).repartition("id").groupBy("id").count()
    table = paragraphs.written(rows, "test-shuffles")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert table.count() == rows.count() == 5000 and spark.conf.get(common.DROP_SHUFFLES) == setting
    common.discard(table)
