"""Substring duplicates by a depth-limited radix sort of suffixes.

Only the first ``length`` bytes of a suffix (its window) matter: windows that
are equal through them are the repeated strings. The sort goes by digits, most
significant first, and after each pass only groups of two or more go on:

1.  The first digit of a window is its least-hashed ``GRAM``-byte string, which
    is the same in equal windows. Windows that start next to each other mostly
    share the place of that string, so one row stands for such a run of
    windows: about one row per 35 bytes, where one per byte could not be moved.
2.  The second digit of a run is all of its bytes. Of runs that are equal, all
    but the first are repeated from their first window to their last. The same
    pass runs within a task's own documents before anything is shuffled, so a
    passage that a third of all documents share leaves one row per task.
3.  What is left are first runs that share their first digit with other runs,
    at the edges of copies and around edits. They are cut into shorter runs, at
    fixed distances from the least string, so that all windows of a shorter run
    share more bytes: that core is the next first digit, and the passes go on
    until runs are single windows, whose core is the window.

Digits are 64-bit polynomial hashes with random coefficients for the bytes; two
different windows count as equal only if the digits of all passes collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import discard, release, text_or_empty, written

LENGTH = 100
GRAM = 32
#: Window starts handled at once, and bytes of text among which a task looks for copies itself.
BLOCK, CHUNK = 1 << 17, 24_000_000
#: Rows without an id come after all others.
NO_ID = (1 << 63) - 1
#: Windows in a run by pass; the first pass's runs have LENGTH - GRAM + 1 at most.
WIDTHS = (16, 1)
RUNS = "akey bigint, ctx bigint, doc bigint, at bigint"


class Hashes:
    """Polynomial hashes of substrings from prefix sums: bytes get random 64-bit values, places powers of an odd number."""

    def __init__(self, seed: int, size: int):
        rng = np.random.default_rng(seed)
        self.value = rng.integers(0, 1 << 64, 256, dtype="uint64")
        base = int(rng.integers(0, 1 << 61, dtype="uint64")) * 8 + 5 & (1 << 64) - 1
        self.power, self.inverse = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b, "uint64")]), dtype="uint64") for b in (base, pow(base, -1, 1 << 64)))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums along the last axis, with a leading 0."""
        out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), "uint64")
        np.cumsum(self.value[data] * self.power[: data.shape[-1]], axis=-1, out=out[..., 1:])
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(29)


def least_places(grams: np.ndarray, width: int) -> np.ndarray:
    """For each start the place of the least of ``width`` hashes from there on, the first of ties."""
    bits = np.uint64(int(len(grams)).bit_length())
    ranked = grams >> bits << bits | np.arange(len(grams), dtype="uint64")
    least, done = ranked, 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    return (least & (np.uint64(1) << bits) - np.uint64(1)).astype("int64")


def runs(data: np.ndarray, starts: np.ndarray, length: int, gram: int, hashes: Hashes) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows in joined texts (``starts``: where each begins, and the end): first digit, second digit, first window, windows, distance to the least string."""
    whole = np.ones(len(data), bool)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        whole[max(a, b - length + 1) : b] = False
    for at in range(0, len(data) - length + 1, BLOCK):
        part = data[at : at + BLOCK + length - 1]
        ok = whole[at : at + len(part) - length + 1]
        if not ok.any():
            continue
        sums = hashes.sums(part)
        grams = mixed((sums[gram:] - sums[:-gram]) * hashes.inverse[: len(part) - gram + 1])
        place = least_places(grams, length - gram + 1)
        edge = np.flatnonzero((place[1:] != place[:-1]) | (ok[1:] != ok[:-1])) + 1
        first = np.concatenate([[0], edge])
        count = np.diff(np.append(first, len(ok)))
        first, count = first[ok[first]], count[ok[first]]
        context = mixed((sums[first + count - 1 + length] - sums[first]) * hashes.inverse[first] + count.astype("uint64"))
        yield grams[place[first]].view("int64"), context.view("int64"), first + at, count, place[first] - first


def packed_at(start: np.ndarray, count: np.ndarray, ahead: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """A run in one number that sorts by start: its first window, windows, distance to the least string and text's tag."""
    return start << 32 | count << 24 | ahead << 16 | tag


def _merged(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unions of overlapping or touching spans that come sorted by document, tag and start."""
    fresh = np.ones(len(doc), bool)
    reach = end.copy()
    group = np.cumsum(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]))
    reach = np.maximum.accumulate(reach + group * (1 << 32)) - group * (1 << 32)
    fresh[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1])
    at = np.flatnonzero(fresh)
    return doc[at], tag[at], start[at], reach[np.append(at[1:], len(doc)) - 1]


def _scan(length: int, gram: int):
    def chunk(docs: list[np.ndarray], tags: list[np.ndarray], texts: list[bytes], hashes: Hashes) -> Iterator[pa.RecordBatch]:
        ids, tag = np.concatenate(docs), np.concatenate(tags)
        starts = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype("int64")
        parts = list(runs(np.frombuffer(b"".join(texts), "u1"), starts, length, gram, hashes))
        if not parts:
            return
        akey, ctx, first, count, ahead = (np.concatenate(x) for x in zip(*parts, strict=True))
        of = np.searchsorted(starts, first, "right") - 1
        doc, start, tag = ids[of], first - starts[of], tag[of]
        order = np.lexsort((start, doc, ctx, akey))
        akey, ctx, doc, start, count, ahead, tag = (x[order] for x in (akey, ctx, doc, start, count, ahead, tag))
        same = np.concatenate([[False], (akey[1:] == akey[:-1]) & (ctx[1:] == ctx[:-1])])
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
        later = same & ((doc != doc[head]) | (start != start[head]))
        # Same id and start in another text is no earlier: it goes on, but is never removed by the first.
        go = ~same | ~later & (tag != tag[head])
        at = packed_at(start, count, ahead, tag)
        yield pa.RecordBatch.from_arrays([pa.array(x[go]) for x in (akey, ctx, doc, at)] + [pa.array(np.zeros(go.sum(), bool))], ["akey", "ctx", "doc", "at", "known"])
        if later.any():
            doc, tag, start, end = doc[later], tag[later], start[later], start[later] + count[later] - 1 + length
            order = np.lexsort((start, tag, doc))
            doc, tag, start, end = _merged(doc[order], tag[order], start[order], end[order])
            yield pa.RecordBatch.from_arrays([pa.array(tag), pa.array(end), pa.array(doc), pa.array(start), pa.array(np.ones(len(doc), bool))], ["akey", "ctx", "doc", "at", "known"])

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(7, BLOCK + length)
        docs, tags, texts, size = [], [], [], 0
        for batch in rows:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                docs.append(part.column("doc").to_numpy())
                tags.append(part.column("tag").to_numpy())
                texts += part.column("text").cast(pa.binary()).to_pylist()
                size += sum(map(len, texts[-len(part) :]))
                if size >= CHUNK:
                    yield from chunk(docs, tags, texts, hashes)
                    docs, tags, texts, size = [], [], [], 0
        if texts:
            yield from chunk(docs, tags, texts, hashes)

    return scan


def _shorter(length: int, width: int):
    """Cuts the runs listed with each text into runs of ``width`` windows: core, second digit, document and place."""

    def shorter(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = 2 * length
        hashes = Hashes(11, most)
        for batch in rows:
            texts = batch.column("text").cast(pa.binary())
            lists = batch.column("runs")
            base = np.concatenate([[0], np.cumsum([len(x.as_py()) for x in texts])]).astype("int64")
            data = np.frombuffer(b"".join(texts.to_pylist()) + bytes(most), "u1")
            of = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
            flat = lists.flatten()
            akeys, ats, docs = flat.field("akey").to_numpy(), flat.field("at").to_numpy(), batch.column("doc").to_numpy()[of]
            for lo in range(0, len(ats), 2048):
                akey, at, doc, text = akeys[lo : lo + 2048], ats[lo : lo + 2048], docs[lo : lo + 2048], of[lo : lo + 2048]
                start, count, ahead, tag = at >> 32, at >> 24 & 0xFF, at >> 16 & 0xFF, at & 0xFFFF
                sums = hashes.sums(data[(base[text] + start)[:, None] + np.arange(most)])
                high, low = ahead // width, (ahead - count + 1) // width
                n = high - low + 1
                row = np.repeat(np.arange(len(at)), n)
                band = high[row] - (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
                first = np.maximum(0, ahead[row] - band * width - width + 1)
                last = np.minimum(count[row] - 1, ahead[row] - band * width)
                digest = lambda a, b, row=row, sums=sums: (sums[row, b] - sums[row, a]) * hashes.inverse[a]
                begin = ahead[row] - band * width
                core = mixed(digest(begin, begin - width + 1 + length) + mixed(akey[row].view("uint64") + band.astype("uint64")))
                context = mixed(digest(first, last + length) + (last - first + 1).astype("uint64"))
                place = packed_at(start[row] + first, last - first + 1, ahead[row] - first, tag[row])
                yield pa.RecordBatch.from_arrays([pa.array(core.view("int64")), pa.array(context.view("int64")), pa.array(doc[row]), pa.array(place)], ["akey", "ctx", "doc", "at"])

    return shorter


def _cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges each text's spans and cuts them out."""
    for batch in rows:
        out = []
        for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
            merged: list[dict] = []
            kept, at = [], 0
            for s, e in sorted((x["s"], x["e"]) for x in spans or []):
                if merged and s <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], e)
                else:
                    merged.append({"start": s, "end": e})
            for x in merged:
                kept.append(text[at : x["start"]])
                at = x["end"]
            out.append((len(text), merged, b"".join(kept) + text[at:]))
        spans = pa.array([x[1] for x in out], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x[0] for x in out], pa.int64()), spans, pa.array([x[2] for x in out], pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def _start(at: Column) -> Column:
    return F.shiftright(at, 32)


def _later(doc: Column, at: Column, first: Column) -> Column:
    """Whether an occurrence is not the first: a greater id, or the same and a greater start."""
    return (doc > first["doc"]) | ((doc == first["doc"]) & (_start(at) > _start(first["at"])))


def cut_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, spans (removed byte ranges, maximal, ends exclusive) and kept (the other bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts
    earlier: in a row with a smaller id, or earlier in the same row. Defined
    cases: a null text is empty; texts shorter than ``length`` stay whole;
    repeated rows (same id and text) count as one and get equal results; other
    rows with equal ids are told apart by 16 bits of their texts' hash and none
    of their strings is earlier for the id's sake; rows without an id come last;
    an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    keyed = keyed.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").bitwiseAND(0xFFFF).alias("tag"), "text")
    scanned = written(keyed.select("doc", "tag", "text").mapInArrow(_scan(length, gram), RUNS + ", known boolean"), "repeat-runs")
    found = scanned.filter("not known").drop("known")

    # First digit: runs whose least string occurs again.
    twice = found.groupBy("akey").agg(F.count("*").alias("n")).filter("n > 1").select("akey")
    rows = written(found.join(twice, "akey", "left_semi"), "repeat-digit")
    known = written(scanned.filter("known").select("doc", F.col("akey").alias("tag"), F.col("at").alias("s"), F.col("ctx").alias("e")), "repeat-known")
    discard(scanned)
    release(spark)
    spans = [known]
    for width in (*WIDTHS, 0):
        # Second digit: of equal runs all but the first are repeated.
        first = rows.groupBy("akey", "ctx").agg(F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("n"))
        first = written(first, "repeat-first")
        copies = rows.join(first.filter("n > 1").drop("n"), ["akey", "ctx"]).filter(_later(F.col("doc"), F.col("at"), F.col("first")))
        windows = F.shiftright("at", 24).bitwiseAND(0xFF)
        end = _start(F.col("at")) + windows - 1 + length
        spans.append(written(copies.select("doc", F.col("at").bitwiseAND(0xFFFF).alias("tag"), _start(F.col("at")).alias("s"), end.alias("e")), "repeat-copies"))
        discard(rows)
        if not width:
            discard(first)
            break
        # First runs that differ but share their first digit go on as shorter runs.
        differ = first.groupBy("akey").agg(F.count("*").alias("n")).filter("n > 1").select("akey")
        ongoing = first.join(differ, "akey", "left_semi").select("akey", F.col("first.doc").alias("doc"), F.col("first.at").alias("at"))
        listed = ongoing.groupBy("doc", F.col("at").bitwiseAND(0xFFFF).alias("tag")).agg(F.collect_list(F.struct("akey", "at")).alias("runs"))
        texts = keyed.select("doc", "tag", "text").join(listed, ["doc", "tag"]).select("doc", "text", "runs")
        rows = written(texts.mapInArrow(_shorter(length, width), RUNS), "repeat-digit")
        discard(first)
        release(spark)

    merged = spans[0]
    for more in spans[1:]:
        merged = merged.unionByName(more)
    joined = written(merged.groupBy("doc", "tag").agg(F.collect_list(F.struct("s", "e")).alias("spans")), "repeat-spans")
    discard(*spans)
    release(spark)
    kind = keyed.schema["doc_id"].dataType.simpleString()
    rows = keyed.join(joined, ["doc", "tag"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_cut, f"doc_id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary").withColumnRenamed("doc_id", id_col)
