"""Substring duplicates by MinHash banding of paragraphs.

Paragraphs are lines. Equal ones fall together by a hash, whatever their
length; of the distinct ones with five words or more,
MinHash signatures over five-word shingles are cut into bands, tuned so that a
pair at the least similarity shares a band in 99.8 of 100 cases. Paragraphs
that share a band are verified by exact Jaccard similarity, verified links
become components, and of each class the first occurrence stays.

A passage inside paragraphs or across lines is no paragraph of its own. Over
the words of the whole document, windows of ``passage`` words are taken whose
least-hashed pair of words is the first or the last. That depends on nothing
but the window's own words, so a window is taken wherever it stands, and two
that follow each other start less than ``passage`` words apart: copies of 29
words or more always share one (shorter ones, from 16 words, often). Each
window has its own first occurrence, and only windows that stand earlier
elsewhere are removed. Removed windows of one document that touch become one
passage, so a text that repeats itself word by word is one row; it is named after
the document that most of its windows stand first in. At both ends it is extended
word by word as far as it agrees with what the window there repeats, but not into
a passage that stands first in its own document.

Words are compared without regard to ASCII case.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm import common
from fleetspark.llm.common import discard, release, text_or_empty
from fleetspark.llm.graph import components
from fleetspark.llm.suffix_dedup import Hashes, mixed

SHINGLE = 5
SIMILARITY = 0.8
#: 16 bands of 5 rows: 1 - (1 - 0.8 ** 5) ** 16 = 0.998 of pairs at similarity 0.8 collide.
BANDS, ROWS = 16, 5
#: Least words of a paragraph that the query judges, of one that is judged unless said otherwise, and of a passage.
PARAGRAPH, LONG, PASSAGE = 1, 20, 16
#: Words of the strings whose hashes say whether a window is taken.
PAIR = 2
CHUNK = 1_000_000
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Every work table drops its job's shuffle files, which together would be several times the input.
written = functools.partial(common.written, drop_shuffles=True)
UNITS = "kind tinyint, doc_id {id}, a bigint, b bigint, key bigint, bands array<bigint>"


class Scanner:
    """Words, paragraphs, signatures and windows of a chunk of texts, in whole-array steps."""

    def __init__(self, passage: int, paragraph: int) -> None:
        self.passage, self.paragraph = passage, paragraph
        self.bytes, self.words = Hashes(21, 2 * CHUNK), Hashes(22, CHUNK)
        rng = np.random.default_rng(23)
        self.mix = rng.integers(0, 1 << 63, SHINGLE, dtype="uint64") * np.uint64(2) + np.uint64(1)
        self.rank = rng.integers(0, 1 << 63, BANDS * ROWS, dtype="uint64") * np.uint64(2) + np.uint64(1)

    def chunk(self, texts: list[bytes]) -> tuple[dict, dict]:
        data = np.frombuffer(b"\n".join(texts).lower() + b"\n", "u1")
        if len(data) > len(self.bytes.power) - 1:
            self.bytes = Hashes(21, len(data))
        space = SPACE[data]
        start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        end = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
        if not len(start):
            return {}, {}
        if len(start) > len(self.words.power) - 1:
            self.words = Hashes(22, len(start))
        sums = self.bytes.sums(data)
        word = mixed((sums[end] - sums[start]) * self.bytes.inverse[start])
        doc_at = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])[:-1]])
        doc = np.searchsorted(doc_at, start, "right") - 1
        line = np.cumsum(data == 10)[start]
        first = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])]))
        count = np.diff(np.append(first, len(word)))
        run = np.zeros(len(word) + 1, "uint64")
        np.cumsum(word * self.words.power[: len(word)], out=run[1:])
        content = lambda at, n: mixed((run[at + n] - run[at]) * self.words.inverse[at] + n.astype("uint64"))
        in_doc = np.arange(len(word)) - np.searchsorted(doc, doc)
        long = count >= self.paragraph
        at, n = first[long], count[long]
        key = content(at, n)
        banded = np.zeros(len(at), bool)  # bands once for each distinct paragraph of the chunk that has a shingle
        banded[np.unique(key, return_index=True)[1]] = True
        banded &= n >= SHINGLE
        paragraphs = {"doc": doc[at], "a": in_doc[at], "b": in_doc[at] + n, "key": key, "banded": banded, "bands": self._bands(word, at[banded], n[banded])}
        at, key = self._windows(doc, content)
        windows = {"doc": doc[at], "a": in_doc[at], "b": in_doc[at] + self.passage, "key": key}
        return paragraphs, windows

    def shingles(self, word: np.ndarray) -> np.ndarray:
        """Hash of the shingle that starts at each word (the last few run over the end)."""
        n = len(word) - SHINGLE + 1
        return mixed(sum(word[k : k + n] * self.mix[k] for k in range(SHINGLE))) if n > 0 else np.zeros(0, "uint64")

    def _bands(self, word: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        if not len(at):
            return np.zeros((0, BANDS), "uint64")
        per = n - SHINGLE + 1
        edge = np.cumsum(per) - per
        place = np.arange(per.sum()) - np.repeat(edge, per) + np.repeat(at, per)
        shingles = self.shingles(word)[place]
        out = np.zeros((len(at), BANDS), "uint64")
        for band in range(BANDS):
            key = np.full(len(at), band, "uint64")
            for rank in self.rank[band * ROWS : (band + 1) * ROWS]:
                key = mixed(key * np.uint64(0x100000001B3) + np.minimum.reduceat((shingles * rank) >> np.uint64(20), edge))
            out[:, band] = key
        return out

    def _windows(self, doc: np.ndarray, content: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of the windows taken: those in one document whose least pair of words is the first or the last."""
        at = np.arange(max(len(doc) - self.passage + 1, 0))
        if not len(at):
            return at, np.zeros(0, "uint64")
        pairs, last = np.arange(len(doc) - PAIR + 1), self.passage - PAIR
        pair = mixed(content(pairs, np.full(len(pairs), PAIR)))
        low, done = pair, 1
        while 2 * done <= last + 1:
            low = np.minimum(low[:-done], low[done:])
            done *= 2
        if done < last + 1:
            low = np.minimum(low[: len(low) - (last + 1 - done)], low[last + 1 - done :])
        taken = (low == pair[at]) | (low == pair[at + last])
        at = at[taken & (doc[at] == doc[at + self.passage - 1])]
        return at, content(at, np.full(len(at), self.passage))


def _scan(passage: int, paragraph: int):
    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(passage, paragraph)
        ids: list[pa.Array] = []
        texts: list[bytes] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            doc_ids = pa.concat_arrays(ids)
            paragraphs, windows = scanner.chunk(texts)
            for k, x in ((0, paragraphs), (1, windows)):
                if not x:
                    continue
                n = len(x["a"])
                if k == 0:
                    offsets = np.concatenate([[0], np.cumsum(x["banded"] * BANDS)]).astype("int32")
                    bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(x["bands"].ravel().view("int64")))
                else:
                    bands = pa.nulls(n, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, k, "int8")), doc_ids.take(pa.array(x["doc"])), pa.array(x["a"].astype("int64")), pa.array(x["b"].astype("int64")), pa.array(x["key"].view("int64")), bands], ["kind", "doc_id", "a", "b", "key", "bands"])

        for batch in rows:
            for at in range(0, len(batch), 128):
                part = batch.slice(at, 128)
                ids.append(part.column("doc_id"))
                got = part.column("text").cast(pa.binary()).to_pylist()
                texts += got
                size += sum(map(len, got))
                if size >= CHUNK:
                    yield from flush()
                    ids, texts, size = [], [], 0
        if texts:
            yield from flush()

    return scan


def _paragraph_texts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted shingle hashes of the paragraphs (a, key) listed with each text."""
    for batch in rows:
        keys, sets = [], []
        for text, wanted in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            words = text.lower().split()
            for x in wanted:
                part = words[x["a"] : x["b"]]
                keys.append(x["key"])
                sets.append(np.unique(np.array([xxhash.xxh3_64_intdigest(b" ".join(part[i : i + SHINGLE])) for i in range(len(part) - SHINGLE + 1)], "uint64")).view("int64"))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["key", "shingles"])


def _edges(passage: int):
    """The windows (a, side) listed with each text: hash of their words, and hashes of the words before (side 0) or after (1), nearest first."""

    def edges(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids, out = [], []
            for at, (text, wanted) in enumerate(zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist(), strict=True)):
                words = text.lower().split()
                for x in wanted:
                    a, b = x["at"], x["at"] + passage
                    part = words[b : b + passage] if x["side"] else words[max(a - passage, 0) : a][::-1]
                    ids.append(at)
                    out.append((a, x["side"], xxhash.xxh3_64_intdigest(b" ".join(words[a:b])) - (1 << 63), [xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in part]))
            a, side, core, near = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(a, pa.int64()), pa.array(side, pa.int32()), pa.array(core, pa.int64()), pa.array(near, pa.list_(pa.int64()))], ["doc_id", "at", "side", "core", "near"])

    return edges


def _groups(rows: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[dict]]]:
    """Groups of rows sorted by a column, over batches."""
    held: list[dict] = []
    for batch in rows:
        for row in batch.to_pylist():
            if held and held[0][column] != row[column]:
                yield held[0][column], held
                held = []
            held.append(row)
    if held:
        yield held[0][column], held


def _buckets(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bands with two or more distinct paragraphs, named by what they hold, so that equal ones fall together."""
    band = np.zeros(0, "int64")
    key = np.zeros(0, "int64")

    def done(band: np.ndarray, key: np.ndarray) -> pa.RecordBatch | None:
        new = np.concatenate([[True], (band[1:] != band[:-1]) | (key[1:] != key[:-1])])
        band, key = band[new], key[new]
        first = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
        size = np.diff(np.append(first, len(band)))
        pick = size > 1
        if not pick.any():
            return None
        names = [xxhash.xxh3_64_intdigest(key[a : a + n].tobytes()) for a, n in zip(first[pick].tolist(), size[pick].tolist(), strict=True)]
        _, once = np.unique(np.array(names, "uint64"), return_index=True)
        at, n = first[pick][once], size[pick][once]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at, n)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(names, "uint64")[once], n).view("int64")), pa.array(key[place])], ["bucket", "key"])

    for batch in rows:
        band, key = np.concatenate([band, batch.column("band").to_numpy()]), np.concatenate([key, batch.column("key").to_numpy()])
        cut = int(np.searchsorted(band, band[-1])) if len(band) else 0
        if cut and (out := done(band[:cut], key[:cut])) is not None:
            yield out
        band, key = band[cut:], key[cut:]
    if len(band) and (out := done(band, key)) is not None:
        yield out


def _verify(similarity: float):
    def alike(x: np.ndarray, y: np.ndarray) -> bool:
        small, large = sorted((len(x), len(y)))
        if small < similarity * large:
            return False
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both >= similarity * (small + large - both)

    def verify(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links that connect each bucket as all its similar pairs would; those reached are compared with those not yet reached."""
        for _, group in _groups(rows, "bucket"):
            left = [(g["key"], np.array(g["shingles"], "int64")) for g in group]
            links = []
            while len(left) > 1:
                queue, left = [left[0]], left[1:]
                while queue and left:
                    x = queue.pop()
                    hit = [alike(x[1], y[1]) for y in left]
                    near = [y for y, h in zip(left, hit, strict=True) if h]
                    links += [(x[0], y[0]) for y in near]
                    queue += near
                    left = [y for y, h in zip(left, hit, strict=True) if not h]
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return verify


def _runs(spans: DataFrame, **columns: Column) -> DataFrame:
    """Spans of one document that touch, as one: doc_id, a, b and what ``columns`` say of them."""
    by = Window.partitionBy("doc_id").orderBy("a", "b")
    spans = spans.withColumn("new", F.coalesce((F.col("a") > F.max("b").over(by.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1)))
    spans = spans.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy("doc_id", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"), *[c.alias(n) for n, c in columns.items()]).drop("run")


def _extended(keyed: DataFrame, gone: DataFrame, kind: str, passage: int) -> DataFrame:
    """Removed runs extended at both ends (doc_id, a, b, first_id), with the spans they repeat (sources: array of id, a, b).

    ``passage`` words each way are enough: further on the copies share another window.
    """
    end = lambda side, at, of: F.struct(F.lit(side).alias("side"), at.alias("at"), F.col(f"{of}.first_id").alias("source"), (at + F.col(f"{of}.shift")).alias("there"))
    ends = gone.withColumn("end", F.explode(F.array(end(0, F.col("a"), "left"), end(1, F.col("b") - passage, "right")))).select("doc_id", "a", "b", "first_id", "low", "high", "end.*")
    ends = written(ends, "paragraph-ends")
    wanted = ends.select("doc_id", "at", "side").unionByName(ends.select(F.col("source").alias("doc_id"), F.col("there").alias("at"), "side")).distinct()
    wanted = wanted.groupBy(F.col("doc_id").alias("of_id")).agg(F.collect_list(F.struct("at", "side")).alias("wanted"))
    edges = keyed.join(wanted, keyed.doc_id.eqNullSafe(wanted.of_id)).select("doc_id", "text", "wanted").mapInArrow(_edges(passage), f"doc_id {kind}, at bigint, side int, core bigint, near array<bigint>")
    edges = written(edges.groupBy("doc_id", "at", "side").agg(F.min(F.struct("core", "near")).alias("x")), "paragraph-edges")  # ids may be repeated
    release(keyed.sparkSession)

    side_of = lambda name: edges.select(*[F.col(c).alias(f"{name}_{c}") for c in ("doc_id", "at", "side")], F.col("x").alias(name))
    met = lambda doc, at, name: F.col(doc).eqNullSafe(F.col(f"{name}_doc_id")) & (F.col(at) == F.col(f"{name}_at")) & (F.col("side") == F.col(f"{name}_side"))
    both = ends.join(side_of("h"), met("doc_id", "at", "h"), "left").join(side_of("t"), met("source", "there", "t"), "left")
    same = F.zip_with(F.col("h.near"), F.col("t.near"), lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, False)
    agree = F.when(F.col("h.core") == F.col("t.core"), F.when(stop > 0, stop - 1).otherwise(F.size(same))).otherwise(0)
    room = F.when(F.col("side") == 0, F.coalesce(F.col("a") - F.col("low"), F.col("a"))).otherwise(F.coalesce(F.col("high") - F.col("b"), F.lit(passage)))
    more = F.greatest(F.least(agree, room), F.lit(0)).cast("bigint")
    # What an end repeats: its window and the words it was extended by.
    span = F.struct(F.col("source").alias("id"), (F.col("there") - F.when(F.col("side") == 0, more).otherwise(0)).alias("a"), (F.col("there") + passage + F.when(F.col("side") == 1, more).otherwise(0)).alias("b"))
    each = both.select("doc_id", "a", "b", "first_id", "side", more.alias("more"), span.alias("span"))
    left, right = (F.max(F.when(F.col("side") == side, F.col("more"))) for side in (0, 1))
    long = each.groupBy("doc_id", "a", "b").agg(F.first("first_id").alias("first_id"), left.alias("l"), right.alias("r"), F.collect_list("span").alias("sources"))
    long = written(long.select("doc_id", (F.col("a") - F.col("l")).alias("a"), (F.col("b") + F.col("r")).alias("b"), "first_id", "sources"), "paragraph-extended")
    discard(ends, edges)
    return long


def repeated_paragraphs(docs: DataFrame, similarity: float = SIMILARITY, passage: int = PASSAGE, id_col: str = "doc_id", text_col: str = "text", paragraph: int = LONG) -> DataFrame:
    """One row per repeated paragraph or passage of a document, the first occurrences included.

    Columns: id, kind ("paragraph" or "passage"), first_word and end_word (its
    words in the document), first_id (where a copy stands first: the smallest
    id), removed (false for first occurrences), n_same (occurrences of a
    paragraph's class). Documents without repeats have no row. Defined cases:
    null and empty texts have no paragraphs; paragraphs under ``paragraph`` words
    and passages under ``passage`` are left alone; paragraphs under five words
    repeat only as exact copies; rows without an id count as the last;
    repeated rows are copies of each other; an empty table gives no rows; other
    columns are ignored. A paragraph's class is named by 64 bits.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = keyed.schema["doc_id"].dataType.simpleString()
    scan = keyed.mapInArrow(_scan(passage, paragraph), UNITS.format(id=kind))
    units = written(scan, "paragraph-units")
    paragraphs, windows = units.filter("kind = 0"), units.filter("kind = 1")

    # Bands shared by distinct paragraphs.
    banded = paragraphs.filter(F.col("bands").isNotNull()).select(F.explode("bands").alias("band"), "key")
    shared = banded.repartition("band").sortWithinPartitions("band", "key").mapInArrow(_buckets, "bucket bigint, key bigint")
    shared = written(shared.distinct(), "paragraph-buckets")
    release(spark)

    # Exact Jaccard within buckets, on the shingles of one occurrence of each paragraph.
    wanted = shared.select("key").distinct()
    holders = paragraphs.join(wanted, "key", "left_semi").groupBy("key").agg(F.min(F.struct("doc_id", "a", "b")).alias("x"))
    holders = holders.groupBy(F.col("x.doc_id").alias("doc_id")).agg(F.collect_list(F.struct(F.col("x.a").alias("a"), F.col("x.b").alias("b"), "key")).alias("wanted"))
    sets = keyed.join(holders, keyed.doc_id.eqNullSafe(holders.doc_id)).select("text", "wanted").mapInArrow(_paragraph_texts, "key bigint, shingles array<bigint>")
    sets = written(sets.dropDuplicates(["key"]), "paragraph-shingles")
    release(spark)
    compared = shared.join(sets, "key").repartition("bucket").sortWithinPartitions("bucket", "key")
    links = written(compared.select("bucket", "key", "shingles").mapInArrow(_verify(similarity), "a bigint, b bigint"), "paragraph-links")
    discard(shared, sets)
    roots = components(links)

    # Classes of paragraphs and their first occurrences.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "a")
    rows = paragraphs.select("doc_id", "a", "b", "key").join(roots.withColumnRenamed("node", "key"), "key", "left")
    rows = rows.select("doc_id", "a", "b", F.coalesce("root", "key").alias("class"))
    first = rows.groupBy("class").agg(F.min(order).alias("first"), F.count("*").alias("n_same")).filter("n_same > 1")
    first = written(first, "paragraph-firsts")  # a plain table: a join with it splits the rows of a hot class
    rows = rows.join(first, "class").select("doc_id", F.lit("paragraph").alias("kind"), "a", "b", F.col("first.doc_id").alias("first_id"), (order != F.col("first")).alias("removed"), "n_same")
    rows = written(rows, "paragraph-classes")
    discard(first, links)
    release(spark)

    # Passages: windows that stand earlier elsewhere, and those that stand first.
    least = written(windows.groupBy("key").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "paragraph-least")
    same = windows.join(least, "key").select("doc_id", "a", "b", F.col("first.doc_id").alias("first_id"), (F.col("first.a") - F.col("a")).alias("shift"), (order != F.col("first")).alias("removed"))
    same = written(same, "paragraph-windows")
    discard(units, least)
    release(spark)
    source = F.struct("first_id", "shift")
    gone = _runs(same.filter("removed"), first_id=F.mode("first_id", True), left=F.min_by(source, F.struct("a", "b")), right=F.max_by(source, F.struct("b", "a")))
    kept = _runs(same.filter("not removed"))
    # How far a run may reach before it meets one that stands first in its document.
    all_runs = gone.withColumn("stays", F.lit(False)).unionByName(kept.withColumn("stays", F.lit(True)), allowMissingColumns=True)
    stays = lambda c: F.when(F.col("stays"), F.col(c))
    before = lambda *by: Window.partitionBy("doc_id").orderBy(*by, F.desc("stays")).rowsBetween(Window.unboundedPreceding, -1)
    roomy = all_runs.withColumn("low", F.max(stays("b")).over(before("a"))).withColumn("high", F.min(stays("a")).over(before(F.desc("b"))))
    found = written(roomy, "paragraph-runs")
    discard(same)
    release(spark)
    long = _extended(keyed, found.filter("not stays"), kind, passage)
    gone = _runs(long, first_id=F.mode("first_id", True)).withColumn("removed", F.lit(True))
    firsts = long.select(F.explode("sources").alias("s")).select(F.col("s.id").alias("doc_id"), "s.a", "s.b").distinct().unionByName(found.filter("stays").select("doc_id", "a", "b"))
    kept = _runs(firsts).select("*", F.col("doc_id").alias("first_id"), F.lit(False).alias("removed"))
    passages = gone.unionByName(kept).select("doc_id", F.lit("passage").alias("kind"), "a", "b", "first_id", "removed", F.lit(None).cast("bigint").alias("n_same"))
    passages = written(passages, "paragraph-passages")
    discard(found, long)
    release(spark)
    out = rows.unionByName(passages)
    return out.select(F.col("doc_id").alias(id_col), "kind", F.col("a").alias("first_word"), F.col("b").alias("end_word"), "first_id", "removed", "n_same")
