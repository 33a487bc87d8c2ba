"""Token operators: ids against the library, round trips, prefix sums."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetspark.llm import queries
from fleetspark.llm.common import work_path
from fleetspark.llm.packing import pack, sequences
from fleetspark.llm.tokens import Encoder, read_spec
from fleetspark.llm.wavelet import WaveletMatrix, from_bytes, read_shards, to_bytes, write_shards

BYTE, WORD = (public_tokenizers.path(f"{x}.json") for x in ("byte_bpe_50k", "word_bpe_49k"))
DOCS = "/root/testdata/sf0.01"
ODD = ["", "a", "  a  b", "x\n\ny ", "naïve — 東京 don't", "É a  b", "<|endoftext|> hi", "a b<|startoftext|>", "I'm\nhere's it's", "\n", "x  \n  y", "ﬁ ǅ Σας", "100%%% $$$ a_b", "\x1c\x1d a", "Iß straße ÄÖÜ'll", "a\tb", "'s 'S d'd 12 345x", "×÷ ×a", "a" * 500]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_library(spark, path):
    encoder, plain = Encoder(read_spec(path)), Tokenizer.from_file(path)
    texts = ODD + [r.text for r in spark.read.parquet(f"{DOCS}/documents.parquet").collect()]
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert got == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text[:80]


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    for n, bits, top in ((0, 16, 1), (1, 3, 8), (3000, 5, 32), (5000, 16, 60000), (1300, 17, 100000)):
        ids = rng.integers(0, top, n).astype("uint32")
        m = WaveletMatrix.build(ids, bits)
        names, lengths, back = from_bytes(to_bytes([None, 7], np.array([0, n]), ids, bits))
        assert names == [None, 7] and lengths.tolist() == [0, n]
        assert (back.decode() == ids).all() and (m.decode() == ids).all()
        for i in rng.integers(0, n, 20) if n else []:
            token = int(ids[i])
            places = np.flatnonzero(ids == token).tolist()
            assert back.access(int(i)) == token and back.count(token) == len(places)
            assert back.rank(token, int(i)) == sum(p < i for p in places)
            assert back.select(token, 0) == places[0] and back.select(token, len(places)) == -1
        if n:
            assert back.locate(int(ids[0])) == np.flatnonzero(ids == ids[0]).tolist()
        assert back.count(top + 1) == 0


def ids_of(path, text, end):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end]


def test_shards(spark, odd, none):
    path = work_path(spark, "test-shards")
    write_shards(odd, path, WORD, 2, shard_tokens=500)
    rows = read_shards(spark, path).orderBy("start").collect()
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode())
    docs = sorted(odd.collect(), key=key)
    assert [r.doc_id for r in rows] == [r.doc_id for r in docs]
    start = 0
    for r, d in zip(rows, docs, strict=True):
        want = ids_of(WORD, d.text, 2)
        assert (r.start, r.n_tokens) == (start, len(want)) and np.frombuffer(r.ids, "<u4").tolist() == want
        start += len(want)
    empty = work_path(spark, "test-shards")
    write_shards(none, empty, WORD, 2)
    assert read_shards(spark, empty).count() == 0


def test_wavelet_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DOCS}/documents.parquet").collect()}
    rows = queries.op8_wavelet_tokens(spark, DOCS).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == sorted(docs)
    tokenizer, start = Tokenizer.from_file(WORD), 0
    for r in rows:
        ids = np.array([*tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def check_pieces(rows, length, last=True):
    """Sequences are gapless and full but for the last."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s, pieces in by.items():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at == length or (s == max(by) and at < length)
    assert sorted(by) == list(range(len(by)))


def test_pack(spark, odd, none):
    pieces = pack(odd, BYTE, length=64)
    rows = pieces.collect()
    check_pieces(rows, 64)
    want = sorted(((r.doc_id or -1), ids_of(BYTE, r.text, 0)) for r in odd.collect())
    got, streams = [], {}
    for r in sorted(rows, key=lambda r: r.sequence_id * 64 + r.offset):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.cut_before == (r.start > 0)
        if r.start == 0:
            streams = []
        assert r.start == len(streams)
        streams += ids
        if r.start + r.length == r.doc_tokens:
            got.append(((r.doc_id or -1), streams))
            assert not r.cut_after
    assert sorted(got) == want
    packed = sequences(pieces, 64).collect()
    assert all(len(r.ids) == 4 * 64 for r in packed)
    assert pack(none, BYTE).count() == 0


def test_pack_query(spark):
    rows = queries.op10_packing(spark, DOCS).collect()
    check_pieces(rows, 1024)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DOCS}/documents.parquet").collect()}
    tokenizer, ids = Tokenizer.from_file(BYTE), {}
    for d in docs:
        ids[d] = np.array([*tokenizer.encode(docs[d], add_special_tokens=False).ids, 0], "<u4")
    total = dict.fromkeys(docs, 0)
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        total[r.doc_id] += r.length
    assert total == {d: len(x) for d, x in ids.items()}


def test_pieces_share_the_ids_of_their_batch_and_go_out_in_small_parts():
    import tracemalloc

    import pyarrow as pa

    from fleetspark.llm import packing

    rng = np.random.default_rng(4)
    n = rng.integers(1, 5000, 2000)
    place = np.cumsum(n) - n + 700
    ids = [rng.integers(0, 50_000, k).astype("<u4").tobytes() for k in n]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000), pa.int64()), pa.array(place), pa.array(n), pa.array(ids, pa.binary())], ["doc_id", "place", "n", "ids"])
    batch = batch.slice(3, 1990)
    tracemalloc.start()
    parts = list(packing._pieces(batch, 1024))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000 < sum(map(len, ids)) and max(p.num_rows for p in parts) <= packing.PIECES_AT_ONCE
    got = [r for p in parts for r in p.to_pylist()]
    assert [r["ids"] for r in got] == [ids[r["doc_id"]][4 * r["start"] : 4 * (r["start"] + r["length"])] for r in got]
    assert [(r["sequence_id"], r["offset"]) for r in got[1:]] == [divmod(place[r["doc_id"]] + r["start"], 1024) for r in got[1:]]
    whole = {}
    for r in got:
        whole[r["doc_id"]] = whole.get(r["doc_id"], b"") + r["ids"]
    assert whole == dict(enumerate(ids[3:1993], 3))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_frequent_pieces_outlive_a_full_cache(monkeypatch, name):
    from fleetspark.llm import tokens

    monkeypatch.setattr(tokens, "MOST_PIECES", 40)
    spec = read_spec(public_tokenizers.path(name))
    encoder, plain = Encoder(spec), Tokenizer.from_str(spec)
    asked = []
    tokenize = encoder._tokens
    monkeypatch.setattr(encoder, "_tokens", lambda shown: asked.append(shown) or tokenize(shown))
    for n in range(30):
        text = f"Often the same words, \u00e9t\u00e9 number{n} x{n}y odd{chr(97 + n % 26)}{chr(97 + n // 26)}"
        got = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids
    assert sum("same" in shown for shown in asked) == 1
    assert len(encoder.known) + len(encoder.old) <= 60


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_a_word_is_kept_once_whatever_sign_follows(path):
    encoder, plain = Encoder(read_spec(path)), Tokenizer.from_file(path)
    words = [f"{chr(97 + n // 26)}{chr(97 + n % 26)}often" for n in range(500)]
    texts = [" ".join(w + sign for w in words) + "." for sign in ("", ",", ".", ";", "!", "'", "7", "-")]
    texts += [*ODD, "end. x' 's d'l. a.\nb, é. naïveé, cafeé été. e!! (so) [n] {k}~ z`", "It's.\n'tis"]
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert got == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text[:80]
    assert len(encoder.known) < 600


def test_texts_encoded_at_once_are_bounded_by_their_characters(monkeypatch):
    from fleetspark.llm import tokens

    monkeypatch.setattr(tokens, "CHARS_AT_ONCE", 2000)
    texts = ["so " * 300, None, "a" * 5000, "", *["it is"] * 700]
    parts = list(tokens.token_batches(read_spec(BYTE), 0)(texts))
    sizes = [len(p) for p in parts]
    assert sum(sizes) == len(texts) and sizes[:2] == [2, 1] and max(sizes) <= 401
    plain = Tokenizer.from_file(BYTE)
    got = [np.frombuffer(x, "<u4").tolist() for p in parts for x in p]
    assert got == [[*plain.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
