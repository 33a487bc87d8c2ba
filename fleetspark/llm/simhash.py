"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. The binary
Golay code puts every 23-bit word within 3 bits of just one codeword. A
segment's keys are the codewords of the words within one bit of it: one key, or
six if the segment is 3 bits off. Two segments that differ in at most two bits
have a word within one bit of both, so they share a key.

If two fingerprints differ in at most four bits, then either one segment is
equal and another differs in at most two bits, or two segments differ in one
bit each, so that a half of each is equal, and the third differs in at most
two. Either way some key made of equal bits and one Golay key agrees: 18
patterns, at most 108 keys a fingerprint, of 32 to 35 bits each. Fingerprints
that share a key are compared bit for bit.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import release, text_or_empty, written
from fleetspark.llm.graph import components

SHINGLE = 4
MOST_BITS = 4
SEED = 42
#: Fixed value: a generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a whole text; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()] if len(words) > shingle else [0]
    ends = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=False)]), "u1").reshape(-1, 8)
    ones = np.zeros(64, "int64")
    for at in range(0, len(hashes), 255):  # sums of up to 255 bits fit into bytes
        ones += np.unpackbits(hashes[at : at + 255], axis=1).sum(axis=0, dtype="u1")
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


@functools.lru_cache(maxsize=1)
def golay_table() -> np.ndarray:
    """The index of the nearest codeword for each of the 2 ** 23 words."""
    codewords = np.zeros(4096, "uint32")
    for message in range(4096):
        rest = message << 11
        for bit in range(22, 10, -1):
            if rest >> bit & 1:
                rest ^= GENERATOR << (bit - 11)
        codewords[message] = message << 11 | rest
    one = np.uint32(1) << np.arange(23, dtype="uint32")
    errors = {0}
    for _ in range(3):
        errors |= {e | int(b) for e in errors for b in one}
    table = np.zeros(1 << 23, "uint16")
    for e in errors:
        table[codewords ^ np.uint32(e)] = np.arange(4096, dtype="uint16")
    return table


def golay_keys(segment: np.ndarray) -> np.ndarray:
    """For each segment its keys in a row of six; a key that stands there already is -1."""
    table, words = golay_table(), segment.astype("uint32")
    near = np.stack([table[words], *[table[words ^ np.uint32(1 << b)] for b in range(23)]], axis=1).astype("int32")
    near.sort(axis=1)
    first = np.ones(near.shape, bool)
    first[:, 1:] = near[:, 1:] != near[:, :-1]
    out = np.full((len(words), 6), -1, "int32")
    row, col = np.nonzero(first)
    out[row, (np.cumsum(first, axis=1) - 1)[row, col]] = near[row, col]
    return out


def keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of unsigned 64-bit fingerprints."""
    parts = [fingerprints >> np.uint64(at) & np.uint64((1 << width) - 1) for at, width in SEGMENTS]
    near = [golay_keys(p) for p in parts]
    halves = [[p & np.uint64((1 << width // 2) - 1), p >> np.uint64(width // 2)] for p, (_, width) in zip(parts, SEGMENTS, strict=True)]
    exact = []
    for k in range(3):
        i, j = (x for x in range(3) if x != k)
        exact += [(k, parts[i]), (k, parts[j])]
        exact += [(k, a << np.uint64(12) | b) for a in halves[i] for b in halves[j]]
    rows, out = [], []
    for pattern, (k, bits) in enumerate(exact):
        row, col = np.nonzero(near[k] >= 0)
        rows.append(row)
        out.append(np.uint64(pattern) << np.uint64(40) | bits[row] << np.uint64(12) | near[k][row, col].astype("uint64"))
    return np.concatenate(rows), np.concatenate(out)


def links_within(group: np.ndarray, most_bits: int) -> list[tuple[int, int]]:
    """Links that connect a group's fingerprints as all its pairs within ``most_bits`` would.

    A fingerprint that has been reached is compared with those not yet reached
    only, so a group of near copies costs little more than its size.
    """
    out, left = [], group
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = np.bitwise_count(left ^ x) <= most_bits
            if hit.any():
                out += [(int(x), int(y)) for y in left[hit]]
                queue += list(left[hit])
                left = left[~hit]
    return out


def _emit_keys(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for at in range(0, len(batch), 4096):
            fp = batch.column("fp").slice(at, 4096).to_numpy()
            row, key = keys(fp.view("uint64"))
            yield pa.RecordBatch.from_arrays([pa.array(key.view("int64")), pa.array(fp[row])], ["key", "fp"])


def _verify(most_bits: int):
    def verify(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a key's rows may go on in the next batch."""
        seen: set[tuple[int, int]] = set()
        held_key, held = np.zeros(0, "int64"), np.zeros(0, "uint64")

        def done(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(start, len(key)))
            two = start[size == 2]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= most_bits]
            found = set(zip(fp[two].view("int64").tolist(), fp[two + 1].view("int64").tolist(), strict=True))
            for at, n in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                for x, y in links_within(fp[at : at + n], most_bits):
                    found.add((x - (1 << 64) if x >> 63 else x, y - (1 << 64) if y >> 63 else y))
            if len(seen) > 1_000_000:
                seen.clear()
            found -= seen
            seen.update(found)
            if found:
                a, b = zip(*found, strict=True)
                return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            return None

        for batch in rows:
            key = np.concatenate([held_key, batch.column("key").to_numpy()])
            fp = np.concatenate([held, batch.column("fp").to_numpy().view("uint64")])
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if cut and (out := done(key[:cut], fp[:cut])):
                yield out
            held_key, held = key[cut:], fp[cut:]
        if len(held_key) and (out := done(held_key, held)):
            yield out

    return verify


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table of doc_id and fp (the fingerprint's bits as bigint)."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def compute(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            fp = np.array([fingerprint(x.as_py(), shingle) for x in batch.column("text")], "uint64")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view("int64"))], ["doc_id", "fp"])

    kind = picked.schema["doc_id"].dataType.simpleString()
    return written(picked.mapInArrow(compute, f"doc_id {kind}, fp bigint"), "fingerprints")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, most_bits: int = MOST_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fp (bigint) and component_id (smallest id that links reach).

    Links join fingerprints, not documents: copies share a fingerprint and are
    never paired. ``most_bits`` may be up to 4, which the keys cover. Defined
    cases: null and wordless texts have fingerprint 0 and link like others;
    repeated rows each get their row; a null id stays null and never becomes a
    component_id unless all ids of the component are null; an empty table gives
    no rows; other columns are ignored, whatever their names.
    """
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError("the keys find up to 4 differing bits")
    spark = docs.sparkSession
    rows = fingerprints(docs, shingle, id_col, text_col)
    least = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    found = least.select("fp").mapInArrow(_emit_keys, "key bigint, fp bigint")
    links = found.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_verify(most_bits), "a bigint, b bigint")
    links = written(links, "fingerprint-links")
    release(spark)
    roots = components(links)
    linked = roots.join(least, roots.node == least.fp).select("fp", "root", "least")
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(named, "root").select("fp", "component_id")
    alone = least.join(named.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    named = written(named.unionByName(alone), "fingerprint-components")
    return rows.join(named, "fp").select(F.col("doc_id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, most_bits: int = MOST_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component one row, with all its columns.

    It is the row with the smallest id; rows of one id are told apart by their
    texts, rows without an id come last, and of rows with equal ids and texts one
    stays. So no component is lost and none keeps two rows, whatever the ids.
    """
    text = text_or_empty(text_col)
    row = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), F.xxhash64(text).alias("h"))
    groups = simhash_groups(docs.select(row.alias("row"), text.alias("text")), shingle, most_bits, "row", "text")
    first = written(groups.filter(F.col("row").eqNullSafe(F.col("component_id"))).select("row.*").distinct(), "simhash-kept")
    same = docs[id_col].eqNullSafe(first["id"]) & (F.xxhash64(text_or_empty(text_col)) == first["h"])
    kept = docs.join(first, same, "left_semi")
    # Repeated rows fall together before they are shuffled.
    whole = F.struct(*[docs[c] for c in docs.columns])
    one = kept.groupBy(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_h")).agg(F.min_by(whole, F.xxhash64(*docs.columns)).alias("_row"))
    return one.select("_row.*")
