"""Benchmark passages in training documents by a distributed positional inverted index.

The index is dealt by document: each task cuts its texts into words and writes,
for every ``SHARD`` bytes of text, one row per distinct term with the places
where it stands (postings). A place counts the words of the shard, with a gap
between documents that no phrase can span; the empty term's postings are the
documents' starts. So the index needs no shuffle, and a word that fills a third
of all texts is one list of bounded length in each shard.

A search takes from the index only the terms of the benchmark and brings each
shard's lists together. A window of an item can occur only where all its terms
have lists; there the list of its rarest term, moved by the term's offset in the
window, is intersected with the next rarest one's until it is empty or all terms
agree: the exact phrase. Near matches are stretches of ``within`` words that hold
all words of a window in any order; they are found from the same lists.

Terms are told apart inside a shard by 64-bit hashes with random coefficients and
between index and benchmark by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import discard, release, text_or_empty, written
from fleetspark.llm.suffix_dedup import Hashes, mixed

WINDOW = 10
WITHIN = 20
#: Words that no document has between two documents of a shard; phrases and stretches must be shorter.
GAP = 64
#: Bytes of text in a shard (or one longer text), and bytes hashed at once.
SHARD, BLOCK = 16 << 20, 1 << 17
#: Places of rarest terms that a search looks at at once, and a number above all places of a shard.
MOST_PLACES, PLACES = 1 << 20, 1 << 33
#: Characters of benchmark text searched for in one pass over the index; more are searched in further passes.
MOST_TEXT = 4_000_000
INDEX = "shard bigint, term binary, n int, postings binary"

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Digits, a-z and all bytes of other alphabets' letters belong to words.
IN_WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


def word_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text's lower-cased bytes."""
    inside = np.zeros(len(data) + 2, "i1")
    inside[1:-1] = IN_WORD[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: Hashes) -> np.ndarray:
    """A hash of each word, some ``BLOCK`` bytes of text at a time."""
    out = np.empty(len(start), "uint64")
    i = 0
    while i < len(start):
        lo = start[i]
        j = max(i + 1, int(np.searchsorted(end, lo + BLOCK, "right")))
        part = data[lo : end[j - 1]]
        h = hashes if len(part) <= BLOCK else Hashes(5, len(part))
        sums, s = h.sums(part), start[i:j] - lo
        out[i:j] = (sums[end[i:j] - lo] - sums[s]) * h.inverse[s]
        i = j
    return mixed(out)


def by_term(key: np.ndarray) -> np.ndarray:
    """The order that brings equal keys together and keeps their places in order."""
    bits = np.uint64(max(1, len(key).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    ranked = np.sort(key & ~low | np.arange(len(key), dtype="uint64"))
    order = (ranked & low).astype("int64")
    high, full = ranked >> bits, key[order]
    if np.any((high[1:] == high[:-1]) & (full[1:] != full[:-1])):
        return np.argsort(key, kind="stable")
    return order


def slices(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """Pieces of some bytes as a binary array."""
    offsets = np.concatenate([[0], np.cumsum(length)]).astype("int64")
    at = np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets.astype("<i4")), pa.py_buffer(data[at].tobytes())])


def shard_index(texts: list[bytes], hashes: Hashes) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Terms, their counts and postings (as steps), the documents' starts and numbers of words."""
    size = np.array([len(t) + 1 for t in texts], "int64")
    data = np.frombuffer((b"\n".join(texts) + b"\n").translate(LOWER), "u1")
    start, end = word_edges(data)
    doc = np.searchsorted(np.cumsum(size), start, "right")
    words = np.bincount(doc, minlength=len(texts))
    base = np.cumsum(words) - words + GAP * np.arange(len(texts))
    if not len(start):
        return pa.array([], pa.binary()), words[:0], pa.array([], pa.binary()), base, words
    order = by_term(key := word_hashes(data, start, end, hashes))
    key, place = key[order], (np.arange(len(order)) + GAP * doc)[order]
    first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    n = np.diff(np.append(first, len(key)))
    step = np.diff(place, prepend=0)
    step[first] = place[first]
    lead = order[first]
    terms = slices(data, start[lead], end[lead] - start[lead])
    ends = np.concatenate([[0], np.cumsum(4 * n)]).astype("<i4")
    return terms, n, pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(step.astype("<u4").tobytes())]), base, words


def _build(shard_bytes: int):
    """Rows of index (kind 0: a term's postings; kind 1: a document) from (doc, text)."""

    def shard(no: int, docs: list, texts: list[bytes], hashes: Hashes) -> Iterator[pa.RecordBatch]:
        terms, n, postings, base, words = shard_index(texts, hashes)
        steps = np.diff(base, prepend=0).astype("<u4").tobytes()
        for term, count, posted in ((pa.array([b""], pa.binary()), np.array([len(texts)]), pa.array([steps], pa.binary())), (terms, n, postings)):
            m = len(term)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, no)), term, pa.array(count.astype("i4")), posted, pa.nulls(m, docs[0].type), pa.nulls(m, pa.int32())], ["shard", "term", "n", "postings", "doc_id", "doc_no"]
            )
        m = len(texts)
        ids = pa.chunked_array(docs).combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, no)), pa.nulls(m, pa.binary()), pa.array(words.astype("i4")), pa.nulls(m, pa.binary()), ids, pa.array(np.arange(m, dtype="i4"))], ["shard", "term", "n", "postings", "doc_id", "doc_no"]
        )

    def build(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(5, BLOCK)
        context = TaskContext.get()
        no = (context.partitionId() if context else 0) << 32
        docs, texts, size = [], [], 0
        for batch in rows:
            ids, column = batch.column("doc_id"), batch.column("text")
            lengths = pc.binary_length(column).to_numpy()
            at = 0
            while at < len(batch):
                room = np.searchsorted(np.cumsum(lengths[at:]), shard_bytes - size, "right")
                more = min(len(batch) - at, max(int(room), 0 if texts else 1))
                if more:
                    docs.append(ids.slice(at, more))
                    texts += column.slice(at, more).to_pylist()
                    size += int(lengths[at : at + more].sum())
                    at += more
                if at < len(batch) or size >= shard_bytes:
                    yield from shard(no, docs, texts, hashes)
                    no, docs, texts, size = no + 1, [], [], 0
        if texts:
            yield from shard(no, docs, texts, hashes)

    return build


@dataclass
class Index:
    """A written index: ``postings`` (shard, term, n, postings) and ``documents`` (shard, doc_no, doc_id, n_words)."""

    table: DataFrame

    @property
    def postings(self) -> DataFrame:
        return self.table.filter("term is not null").select("shard", "term", "n", "postings")

    @property
    def documents(self) -> DataFrame:
        return self.table.filter("term is null").select("shard", "doc_no", "doc_id", F.col("n").cast("bigint").alias("n_words"))

    def drop(self) -> None:
        discard(self.table)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD) -> Index:
    """The positional index of whole texts; a null text is one without words."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return Index(written(rows.mapInArrow(_build(shard_bytes), f"{INDEX}, doc_id {kind}, doc_no int"), "phrase-index"))


def words_of_text(text: str | None) -> list[bytes]:
    """The lower-cased words of one text."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
    start, end = word_edges(np.frombuffer(data, "u1"))
    return [data[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]


class Phrases:
    """Windows of some items: numbers of their terms in one row, and where each window starts and how long it is."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.terms: dict[bytes, int] = {b"": 0}
        flat, self.ids, start, length, item = [], [], [], [], []
        for name, text in items:
            words = words_of_text(text)
            if words:
                size = min(window, len(words))
                start.append(np.arange(len(flat), len(flat) + len(words) - size + 1))
                length.append(np.full(len(start[-1]), size))
                item.append(np.full(len(start[-1]), len(self.ids)))
                flat += [self.terms.setdefault(w, len(self.terms)) for w in words]
                self.ids.append(name)
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, "int64")
        self.flat, self.start, self.length, self.item = np.array(flat, "int64"), join(start), join(length), join(item)


class Lists:
    """The postings of one shard for the terms of some items, as one sorted array of (term, place) keys."""

    def __init__(self, tid: np.ndarray, postings: list[bytes], terms: int):
        order = np.argsort(tid)
        n = np.array([len(postings[i]) // 4 for i in order], "int64")
        steps = np.frombuffer(b"".join([postings[i] for i in order]), "<u4").astype("int64")
        self.begin, self.count = np.zeros(terms, "int64"), np.zeros(terms, "int64")
        begin = np.cumsum(n) - n
        self.begin[tid[order]], self.count[tid[order]] = begin, n
        run = np.cumsum(steps)
        place = run - np.repeat(run[begin] - steps[begin], n) + GAP
        self.keys = np.repeat(tid[order].astype("int64") * PLACES, n) + place

    def of(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For several terms at once: which of them, and its places."""
        n = self.count[term]
        which = np.repeat(np.arange(len(term)), n)
        at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.begin[term], n)
        return which, self.keys[at] - term[which] * PLACES - GAP

    def next_from(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How far behind each place the next one of the term is; far if there is none."""
        wanted = term * PLACES + place + GAP
        at = np.searchsorted(self.keys, wanted)
        return self.keys[np.minimum(at, len(self.keys) - 1)] - wanted + np.where(at == len(self.keys), 2 * PLACES, 0)


def exact_starts(lists: Lists, terms: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows (rows: terms from the rarest up, and their offsets) stand where: the rarest term's places, kept if each next term stands there too."""
    which, place = lists.of(terms[:, 0])
    start = place - offsets[which, 0]
    for r in range(1, terms.shape[1]):
        ok = lists.next_from(terms[which, r], start + offsets[which, r]) == 0
        which, start = which[ok], start[ok]
    return which, start


def near_starts(lists: Lists, terms: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows have all their words in a stretch of ``within`` words, and where such stretches start, each with one of the words."""
    which, anchor = lists.of(terms[:, 0])
    for r in range(1, terms.shape[1]):
        ok = lists.next_from(terms[which, r], anchor - within + 1) <= 2 * within - 2
        which, anchor = which[ok], anchor[ok]
    both = np.unique(((which * PLACES + anchor + GAP)[:, None] - np.arange(within)).ravel())
    which, start = both // PLACES, both % PLACES - GAP
    leads = np.zeros(len(start), bool)
    for r in range(terms.shape[1]):
        ahead = lists.next_from(terms[which, r], start)
        ok = (ahead >= 0) & (ahead < within)
        which, start, leads = which[ok], start[ok], (leads | (ahead == 0))[ok]
    return which[leads], start[leads]


def union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of overlapping or touching ranges."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    fresh = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return start[fresh], reach[np.append(fresh[1:], len(start)) - 1]


RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
MATCHES = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
MATCH = "array<struct<item_id:string,start:bigint,end:bigint>>"
HITS = f"shard bigint, doc_no int, spans array<struct<start:bigint,end:bigint>>, phrases {MATCH}, near {MATCH}"


def _search(phrases: Phrases, within: int):
    def matches(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
        """Item, start and end of matches; those of an item that overlap are joined."""
        item, start, end = (np.concatenate(x) for x in zip(*found, strict=True))
        far = int(end.max()) + 1
        a, b = union(item * far + start, item * far + end)
        return a // far, a % far, a % far + b - a

    def search(group: pa.Table) -> pa.Table:
        lists = Lists(group.column("tid").to_numpy(), group.column("postings").to_pylist(), len(phrases.terms))
        base = lists.of(np.array([0]))[1]
        have = np.concatenate([[0], np.cumsum(lists.count[phrases.flat] > 0)])
        whole = np.flatnonzero(have[phrases.start + phrases.length] - have[phrases.start] == phrases.length)
        # The windows' terms from the rarest of this shard up; shorter windows repeat their last term.
        offsets = np.minimum(np.arange(phrases.length[whole].max(initial=1)), phrases.length[whole][:, None] - 1)
        terms = phrases.flat[phrases.start[whole][:, None] + offsets] if len(whole) else offsets
        order = np.argsort(lists.count[terms], axis=1, kind="stable")
        terms, offsets = np.take_along_axis(terms, order, 1), np.take_along_axis(offsets, order, 1)
        exact, near = [], []
        load = np.cumsum(lists.count[terms[:, 0]]) if len(whole) else np.zeros(0, "int64")
        at = 0
        while at < len(whole):
            to = max(at + 1, int(np.searchsorted(load, (load[at - 1] if at else 0) + MOST_PLACES, "right")))
            which, start = exact_starts(lists, terms[at:to], offsets[at:to])
            w = whole[at + which]
            exact.append((phrases.item[w], start, start + phrases.length[w]))
            which, start = near_starts(lists, terms[at:to], within)
            w = whole[at + which]
            fits = phrases.length[w] <= within
            near.append((phrases.item[w][fits], start[fits], start[fits] + within))
            at = to
        shard = group.column("shard")[0].as_py()
        rows: dict[int, list] = {}
        ends = np.append(base[1:] - GAP, np.iinfo("int64").max)
        for kind, found in ((1, exact), (2, near)):
            if any(len(x[0]) for x in found):
                item, start, end = matches(found)
                doc = np.searchsorted(base, start, "right") - 1
                for i, d, s, e in zip(item.tolist(), doc.tolist(), (start - base[doc]).tolist(), (np.minimum(end, ends[doc]) - base[doc]).tolist(), strict=True):
                    rows.setdefault(d, [[], [], []])[kind].append({"item_id": phrases.ids[i], "start": s, "end": e})
        for row in rows.values():
            if row[1]:
                start, end = union(*(np.array([m[k] for m in row[1]]) for k in ("start", "end")))
                row[0] = [{"start": s, "end": e} for s, e in zip(start.tolist(), end.tolist(), strict=True)]
        cols = [pa.array([r[k] for r in rows.values()], t) for k, t in ((0, RANGES), (1, MATCHES), (2, MATCHES))]
        return pa.Table.from_arrays([pa.array([shard] * len(rows), pa.int64()), pa.array(list(rows), pa.int32()), *cols], ["shard", "doc_no", "spans", "phrases", "near"])

    return search


def search_index(index: Index, items: DataFrame, window: int = WINDOW, within: int = WITHIN, most_text: int = MOST_TEXT) -> DataFrame:
    """Hits by document of the index: spans (unions of phrases), phrases and near matches, all in words of the document.

    ``items`` has item_id (string) and text. They are searched for in blocks of
    about ``most_text`` characters, each in one pass over the index.
    """
    if max(window, within) > GAP:
        raise ValueError(f"phrases and stretches must not be longer than {GAP} words")
    spark = items.sparkSession
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // most_text))
    found = None
    for block in range(blocks):
        mine = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        phrases = Phrases([tuple(r) for r in mine.select("item_id", "text").collect()], window)
        vocabulary = spark.createDataFrame([(bytearray(t), n) for t, n in phrases.terms.items()], "term binary, tid int")
        lists = index.postings.join(F.broadcast(vocabulary), "term").select("shard", "tid", "postings")
        hits = written(lists.groupBy("shard").applyInArrow(_search(phrases, within), HITS), "phrase-hits")
        found = hits if found is None else found.unionByName(hits)
    if blocks == 1:
        return found
    flat = found.groupBy("shard", "doc_no").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "phrases", "near")])

    def joined(done, s):
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (s["start"] <= F.try_element_at(done, F.lit(-1))["end"]), longer).otherwise(F.concat(done, F.array(s)))

    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return flat.withColumn("spans", F.aggregate(F.array_sort("spans"), empty, joined))


def contaminated_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, within: int = WITHIN, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row per input row: doc_id, n_words, spans, phrases and near.

    ``phrases`` are places where ``window`` or more consecutive words of an item
    stand (all words of a shorter item), overlapping ones of an item joined;
    ``spans`` their unions; ``near`` joined stretches of ``within`` words that
    hold all words of a window in any order. Places count words, ends are
    exclusive. Defined cases: null texts and items have no words and match
    nothing; repeated documents each get their row, repeated items and items of
    one id count once; an item without an id marks words and has a null id in
    the lists; items longer than ``within`` words a window have no near matches;
    no items: no hits; no documents: no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("string").alias("item_id"), text_or_empty("text").alias("text")).distinct()
    index = build_index(docs, id_col, text_col)
    hits = search_index(index, asked, window, within)
    documents = written(index.documents, "phrase-documents")
    index.drop()
    release(spark)
    none = lambda c: F.coalesce(F.col(c), F.array().cast(hits.schema[c].dataType)).alias(c)
    out = documents.join(hits, ["shard", "doc_no"], "left")
    return out.select(F.col("doc_id").alias(id_col), "n_words", none("spans"), none("phrases"), none("near"))
