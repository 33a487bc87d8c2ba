"""Token ids as wavelet matrices, one compressed file per shard.

A wavelet matrix holds a sequence as one bit-plane per bit of a symbol, from
the highest: each plane has the bits in the current order, and the next order
puts the zeros before the ones. With counts of ones at every 512 bits it gives
the token at a place, how often an id occurs before a place and where its k-th
occurrence is, without decoding the shard.

Shards are written by Spark as rows (part, shard, bytes) of a Parquet table, so
any store that Spark writes to will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import small, written
from fleetspark.llm.tokens import read_spec, token_batches

MAGIC = b"WMX1"
BLOCK = 512
SHARD_TOKENS = 1 << 19
#: Partitions whose offsets are broadcast at most.
MOST_PARTS = 1_000_000
FILES = "part int, shard int, local_start bigint, n_tokens bigint, bytes binary"


class WaveletMatrix:
    """Symbols below 2 ** bits; ``planes`` are packed bits, ``zeros`` how many zeros each plane has."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.bits = n, zeros, planes, len(planes)
        self._counts: list[np.ndarray] | None = None

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        if len(ids) and int(ids.max()) >> bits:
            raise ValueError(f"id {int(ids.max())} needs more than {bits} bits")
        now, zeros, planes = ids.astype("uint32" if bits > 16 else "uint16"), [], []
        for level in range(bits - 1, -1, -1):
            ones = (now & now.dtype.type(1 << level)).astype(bool)
            planes.append(np.packbits(ones))
            low, high = np.flatnonzero(~ones), np.flatnonzero(ones)
            zeros.append(len(low))
            now = now.take(np.concatenate([low, high]))
        return cls(len(ids), zeros, planes)

    def decode(self) -> np.ndarray:
        """All ids, undoing the planes' orders from the last one up."""
        kind = "uint32" if self.bits > 16 else "uint16"
        now = np.zeros(self.n, kind)
        for level in range(self.bits):
            plane = self.bits - 1 - level
            ones = np.unpackbits(self.planes[plane], count=self.n).view(bool)
            above = np.empty(self.n, kind)
            above[np.flatnonzero(~ones)] = now[: self.zeros[plane]]
            above[np.flatnonzero(ones)] = now[self.zeros[plane] :] | np.array(1 << level, kind)
            now = above
        return now

    def _ones(self, plane: int, i: int) -> int:
        """Ones before place i: the count at its block, and the bits of the block up to it."""
        if self._counts is None:
            step = BLOCK // 8
            self._counts = []
            for p in self.planes:
                per = np.add.reduceat(np.bitwise_count(p).astype("int64"), np.arange(0, len(p), step)) if len(p) else np.zeros(0, "int64")
                self._counts.append(np.concatenate([[0], np.cumsum(per)]))
        block = i // BLOCK
        tail = np.unpackbits(self.planes[plane][block * BLOCK // 8 : (i + 7) // 8], count=i - block * BLOCK)
        return int(self._counts[plane][block]) + int(tail.sum())

    def access(self, i: int) -> int:
        """The id at place i."""
        out = 0
        for plane in range(self.bits):
            before = self._ones(plane, i)
            bit = self._ones(plane, i + 1) - before
            i = self.zeros[plane] + before if bit else i - before
            out = out << 1 | bit
        return out

    def _range(self, token: int, i: int) -> tuple[int, int]:
        lo, hi = 0, i
        for plane in range(self.bits):
            a, b = self._ones(plane, lo), self._ones(plane, hi)
            lo, hi = (self.zeros[plane] + a, self.zeros[plane] + b) if token >> (self.bits - 1 - plane) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """How often an id occurs before place i."""
        if token >> self.bits:
            return 0
        lo, hi = self._range(token, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The place of occurrence k (from 0) of an id; -1 if there are fewer."""
        if k >= self.count(token):
            return -1
        at = self._range(token, self.n)[0] + k
        for plane in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - plane) & 1
            want = at - self.zeros[plane] if one else at
            lo, hi = 0, self.n - 1  # the place whose rank is `want` and which holds the bit
            while lo < hi:
                mid = (lo + hi) // 2
                ones = self._ones(plane, mid + 1)
                lo, hi = (lo, mid) if (ones if one else mid + 1 - ones) > want else (mid + 1, hi)
            at = lo
        return at

    def locate(self, token: int) -> list[int]:
        """All places of an id."""
        return [self.select(token, k) for k in range(self.count(token))]


def to_bytes(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    """A shard: header, zeros per plane, documents (ids and lengths, compressed), planes (each compressed if that helps)."""
    matrix = WaveletMatrix.build(ids, bits)
    known = np.array([d is not None for d in doc_ids], "u1")
    docs = zlib.compress(known.tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + lengths.astype("<u4").tobytes(), 1)
    out = [MAGIC, struct.pack("<QIII", len(ids), bits, len(doc_ids), len(docs)), np.array(matrix.zeros, "<u8").tobytes(), docs]
    for plane in matrix.planes:
        raw = plane.tobytes()
        packed = zlib.compress(raw, 1) if plane.size and np.count_nonzero(plane) < 0.3 * plane.size else raw
        short = len(packed) < len(raw)
        out += [struct.pack("<IB", len(packed) if short else len(raw), short), packed if short else raw]
    return b"".join(out)


def from_bytes(data: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """Document ids, their lengths and the matrix of a shard."""
    if data[:4] != MAGIC:
        raise ValueError("not a wavelet shard")
    n, bits, n_docs, size = struct.unpack_from("<QIII", data, 4)
    at = 24
    zeros = np.frombuffer(data, "<u8", bits, at).tolist()
    at += 8 * bits
    docs = zlib.decompress(data[at : at + size])
    at += size
    known, doc_ids = np.frombuffer(docs, "u1", n_docs), np.frombuffer(docs, "<i8", n_docs, n_docs)
    lengths = np.frombuffer(docs, "<u4", n_docs, 9 * n_docs)
    planes = []
    for _ in range(bits):
        size, short = struct.unpack_from("<IB", data, at)
        raw = data[at + 5 : at + 5 + size]
        planes.append(np.frombuffer(zlib.decompress(raw) if short else raw, "u1"))
        at += 5 + size
    return [int(d) if k else None for d, k in zip(doc_ids, known, strict=True)], lengths, WaveletMatrix(n, zeros, planes)


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, bits: int = 16, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes the documents in ascending id order (null ids first, then ties by text) and writes the shards.

    A shard ends with the document that brings it to ``shard_tokens`` ids, so a
    task holds one shard and one batch of texts. Defined cases: a null text is
    empty and gives its end id alone; repeated rows are documents of their own;
    an empty table writes no shard; other columns are ignored.
    """
    batches = token_batches(read_spec(tokenizer), end_id)
    ordered = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def shards(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, total = TaskContext.get().partitionId(), 0, 0
        names: list = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(x) // 4 for x in held], "int64")
            data = to_bytes(names, lengths, np.frombuffer(b"".join(held), "<u4"), bits)
            return pa.RecordBatch.from_pylist([{"part": part, "shard": number, "local_start": total, "n_tokens": size, "bytes": data}], schema)

        for batch in rows:
            doc_ids, at = batch.column("doc_id").to_pylist(), 0
            for ids in batches(batch.column("text").to_pylist()):
                for x in ids:
                    names.append(doc_ids[at])
                    held.append(x)
                    size += len(x) // 4
                    at += 1
                    if size >= shard_tokens:
                        yield flush()
                        total, number = total + size, number + 1
                        names.clear()
                        held.clear()
                        size = 0
        if held:
            yield flush()

    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("local_start", pa.int64()), ("n_tokens", pa.int64()), ("bytes", pa.binary())])
    ordered.mapInArrow(shards, FILES).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files at ``path``: doc_id, start, n_tokens and ids (little-endian unsigned 32-bit).

    A shard starts where the partitions before it end (one small row each,
    broadcast up to ``MOST_PARTS`` of them) and the shards before it in its
    partition do.
    """
    files = spark.read.schema(FILES).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = written(totals.select("part", before.alias("base")).coalesce(1), "wavelet-bases")
    files = files.join(small(bases, MOST_PARTS), "part")
    files = files.select((F.col("base") + F.col("local_start")).alias("start"), "bytes")

    def documents(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start, data in zip(batch.column("start").to_pylist(), batch.column("bytes"), strict=True):
                doc_ids, lengths, matrix = from_bytes(data.as_py())
                ends = np.cumsum(lengths.astype("int64"))
                raw = matrix.decode().astype("<u4")
                offsets = np.concatenate([[0], 4 * ends]).astype("int32")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(start + ends - lengths),
                        pa.array(lengths.astype("int64")),
                        pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return files.mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
