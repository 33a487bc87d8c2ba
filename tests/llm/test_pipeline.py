"""The pipeline's stages against brute force on the small documents table."""

import re

import numpy as np
import public_tokenizers
from test_rows import all_spans, reshared, stats
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from fleetspark.llm.quality_rules import quality_rules

DIR = "/root/testdata/sf0.001"


def masked(text):
    out, at = "", 0
    for s, _, e in all_spans(text):
        if s >= at:
            out += text[at:s] + "<secret>"
        at = max(at, e)
    return out + text[at:]


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    kept = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert [*stages] == ["quality_rules", "simhash_dedup", "secret_scan", "mix_sources", "packing"]

    verdict = {r.doc_id for r in quality_rules(docs).filter("kept").collect()}
    df = stages["quality_rules"](spark, docs, DIR)
    assert df.columns == docs.columns and {r.doc_id for r in df.collect()} == verdict
    kept = {d: r for d, r in kept.items() if d in verdict}
    assert all(stats(r.text)[0] >= 10 for r in kept.values())

    groups = plain_components([(d, plain_fingerprint(r.text)) for d, r in kept.items()])
    df = stages["simhash_dedup"](spark, df, DIR)
    kept = {d: kept[d] for (d, _), c in groups.items() if d == c}
    assert df.columns == docs.columns and sorted(r.doc_id for r in df.collect()) == sorted(kept)

    df = stages["secret_scan"](spark, df, DIR)
    got = {r.doc_id: r for r in df.collect()}
    assert df.columns == docs.columns and set(got) == set(kept)
    for d, r in got.items():
        assert r.text == masked(kept[d].text) and r.n_chars == len(r.text) and r.source == kept[d].source

    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for d, r in got.items()}
    sizes, largest = {}, {}
    for d, r in got.items():
        sizes[r.source] = sizes.get(r.source, 0) + words[d]
        largest[r.source] = max(largest.get(r.source, 0), words[d])
    want, taken = reshared(sizes, (3, 1, 2), 1.5, 2), dict.fromkeys(sizes, 0)
    df = stages["mix_sources"](spark, df, DIR).cache()
    rows = df.collect()
    for r in rows:
        assert r.text == got[r.doc_id].text
        taken[r.source] += words[r.doc_id]
    assert df.columns == docs.columns and all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    assert max(sum(r.doc_id == d for r in rows) for d in {r.doc_id for r in rows}) <= 2

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = stages["packing"](spark, df, DIR).collect()
    stream = b"".join(bytes(p.ids) for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)))
    total = sorted(tuple(x) for x in np.split(np.frombuffer(stream, "<u4"), np.flatnonzero(np.frombuffer(stream, "<u4") == 0) + 1) if len(x))
    assert total == sorted(tuple([*tokenizer.encode(r.text, add_special_tokens=False).ids, 0]) for r in rows)


def test_run(spark):
    import __spark_entry__

    found = __spark_entry__.queries()
    assert sorted(x for x in found if x.startswith("op")) == sorted(f"op{n}_{x}" for n, x in ((1, "ordinal_quality"), (2, "paragraph_dedup"), (3, "secret_scan"), (4, "mix_sources"), (5, "suffix_dedup"), (6, "collision_neighbours"), (7, "simhash_dedup"), (8, "wavelet_tokens"), (9, "quality_rules"), (10, "packing"), (11, "centroid_clusters"), (12, "phrase_decontamination"), (13, "vector_codes")))
    out = found["pipeline"](spark, DIR)
    assert out.count() > 0 and {"doc_id", "sequence_id", "ids"} <= set(out.columns)


def test_run_on_odd_and_empty_tables(spark, odd, none, tmp_path):
    """Nulls, copies, repeated rows, missing ids and a text of 5 MB pass through all stages; an empty table gives no rows."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    long = " ".join(f"word{n % 9973}" for n in range(550_000))
    rows = odd.select(*columns).unionByName(spark.createDataFrame([(900, long, "en", "web", len(long))], odd.select(*columns).schema))
    rows.write.parquet(f"{tmp_path}/odd/documents.parquet")
    none.select(*columns).write.parquet(f"{tmp_path}/none/documents.parquet")
    pieces = corpus_pipeline.run(spark, f"{tmp_path}/odd").select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset").collect()
    good = {r.doc_id for r in quality_rules(rows).filter("kept").collect()}
    assert len(long) > 4_500_000 and {p.doc_id for p in pieces} <= good
    assert not {p.doc_id for p in pieces} & {4, 5, 6, 7} and (900 in good) == any(p.doc_id == 900 for p in pieces)
    ends = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends.get(p.sequence_id, 0) and p.length > 0
        ends[p.sequence_id] = p.offset + p.length
    assert all(n <= 1024 for n in ends.values())
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
