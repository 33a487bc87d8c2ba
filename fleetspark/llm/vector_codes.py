"""Vector code compression: product codes in whole numbers over Hilbert-sorted flat blocks.

Vectors are cut into ``parts`` equal parts, and each part position has a codebook.
A task takes ``CHUNK`` vectors at a time; it sorts the chunk's parts of one
position along a Hilbert curve and cuts them into flat blocks of ``BLOCK`` parts,
which so lie close together. A block stores its box (least and greatest value of
each component) and its sums. Nothing is shuffled for this.

In each round a block first meets all entries as a box: an entry whose least
distance to the box exceeds another's greatest distance cannot be nearest to any
part inside. If one entry is left, the block's stored sums go to it unread;
otherwise a small exact whole-number kernel compares the block's parts with the
entries left. The tasks' sums per entry are added up by Spark; only they, one per
entry and component, reach the driver.

The last assignment brings the codes of a chunk's parts together by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.centroids import batches_of, finite, matrix, summed, whole_numbers
from fleetspark.llm.common import discard, release, small, written

#: Vectors sorted together, and parts in a flat block.
CHUNK, BLOCK = 32_768, 64
#: Vectors longer than this (in whole numbers) could have summed squared distances that no long holds.
LONGEST = float(1 << 28)
#: Labels whose sums are broadcast; of more labels only this many with the most rows are, and the rest are joined by a shuffle.
MOST_LABELS = 100_000


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of points (whole numbers under 2^bits, one row each) on a Hilbert curve.

    Skilling's transform: the coordinates' bits are turned into the curve's from
    the highest down, then written out bit plane by bit plane.
    """
    x = points.astype("int64").T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            set_here = (x[i] & q) != 0
            swap = np.where(set_here, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_here, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], "int64")
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], "int64")
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def curve_order(points: np.ndarray) -> np.ndarray:
    """The order of points along a Hilbert curve through the box that holds them (of wide parts, the first 62 components)."""
    points = points[:, :62]
    bits = max(1, min(10, 62 // points.shape[1]))
    low = points.min(axis=0)
    span = np.maximum(points.max(axis=0) - low + 1, 1)
    return np.argsort(hilbert_keys((points - low) * (1 << bits) // span, bits), kind="stable")


def flat_blocks(vectors: np.ndarray, parts: int, block: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Part position, parts in curve order and the rows they belong to, for each flat block of a chunk."""
    width = vectors.shape[1] // parts
    for p in range(parts):
        points = vectors[:, p * width : (p + 1) * width]
        order = curve_order(points)
        for at in range(0, len(order), block):
            rows = order[at : at + block]
            yield p, points[rows], rows


def shortlist(lo: np.ndarray, hi: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Whether each entry can be nearest to (or tie for) some point of each box."""
    below, above = lo[:, None] - entries, entries - hi[:, None]
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
    greatest = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
    return least <= greatest.min(axis=1)[:, None]


def kernel(values: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each part; the lower index wins ties."""
    step = values[:, None] - entries
    d = (step * step).sum(axis=2)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(d)), best]


def _numbers(column: pa.Array, width: int, kind: str = "<i4") -> np.ndarray:
    """Binary values as rows of whole numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).astype("int64")


def _points(value: pa.Scalar, width: int) -> np.ndarray:
    return np.frombuffer(value.as_py(), "<i4").reshape(-1, width).astype("int64")


def shortlists(batch: pa.RecordBatch, codebooks: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each block of a batch: its number in the batch, part position, and the entries left after its box."""
    width = codebooks.shape[2]
    part = batch.column("part").to_numpy()
    lo, hi = _numbers(batch.column("lo"), width), _numbers(batch.column("hi"), width)
    left = np.zeros((len(part), codebooks.shape[1]), bool)
    for p in np.unique(part).tolist():
        at = np.flatnonzero(part == p)
        left[at] = shortlist(lo[at], hi[at], codebooks[p])
    for i, p in enumerate(part.tolist()):
        yield i, p, np.flatnonzero(left[i])


def _sums(codebooks: np.ndarray):
    parts, entries, width = codebooks.shape

    def sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), "int64")
        for batch in batches_of(rows):
            if not len(batch):
                continue
            stored = _numbers(batch.column("sums"), width, "<i8")
            values, size = batch.column("values"), batch.column("n").to_numpy()
            for i, p, left in shortlists(batch, codebooks):
                if len(left) == 1:
                    total[p, left[0], :width] += stored[i]
                    total[p, left[0], width] += size[i]
                    continue
                points = _points(values[i], width)
                best, _ = kernel(points, codebooks[p, left])
                np.add.at(total[p, :, :width], left[best], points)
                total[p, :, width] += np.bincount(left[best], minlength=entries)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.int64()))], ["sums"])

    return sums


def _codes(codebooks: np.ndarray):
    width = codebooks.shape[2]

    def codes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(rows):
            values, code, error = batch.column("values"), [], []
            for i, p, left in shortlists(batch, codebooks) if len(batch) else ():
                points = _points(values[i], width)
                best, d = kernel(points, codebooks[p, left])
                code.append(left[best].astype("<i4").tobytes())
                error.append(d.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("part"), batch.column("rows"), pa.array(code, pa.binary()), pa.array(error, pa.binary())], ["chunk", "part", "rows", "codes", "errors"])

    return codes


def _together(parts: int, names: list[str]):
    """Codes and errors of a chunk's vectors from its blocks (left) beside the vectors' rows (right)."""

    def together(blocks: pa.Table, vectors: pa.Table) -> pa.Table:
        n = vectors.num_rows
        code, error = np.zeros((n, parts), "int64"), np.zeros(n, "int64")
        for p, rows, codes, errors in zip(*(blocks.column(c).to_pylist() for c in ("part", "rows", "codes", "errors")), strict=True):
            at = np.frombuffer(rows, "<i4")
            code[at, p] = np.frombuffer(codes, "<i4")
            error[at] += np.frombuffer(errors, "<i8")
        row = vectors.column("row").to_numpy()
        kept = [vectors.column(c) for c in names]
        return pa.Table.from_arrays([*kept, pa.array(list(code[row].astype("i4")), pa.list_(pa.int32())), pa.array(error[row])], [*names, "codes", "error"])

    return together


def _chunks(scale: int, parts: int, chunk_rows: int, block: int):
    """Vectors with their chunk and row in it, followed by the chunk's flat blocks."""

    def chunk(no: int, ids: list, labels: list, vectors: list) -> Iterator[pa.RecordBatch]:
        ids, labels = (pa.chunked_array(x).combine_chunks() for x in (ids, labels))
        v = np.concatenate(vectors)
        n = len(v)
        nothing = lambda m, kind: pa.nulls(m, kind)
        binary = pa.binary()
        names = ["chunk", "part", "n", "lo", "hi", "sums", "values", "rows", "id", "label"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, no)), nothing(n, pa.int32()), pa.array(np.arange(n, dtype="i4")), *[nothing(n, binary)] * 5, ids, labels], names
        )
        short = lambda x: x.astype("<i4").tobytes()
        out = [(p, len(rows), short(x.min(axis=0)), short(x.max(axis=0)), x.sum(axis=0).tobytes(), short(x), short(rows)) for p, x, rows in flat_blocks(v, parts, block)]
        p, size, *rest = zip(*out, strict=True)
        m = len(out)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, no)), pa.array(p, pa.int32()), pa.array(size, pa.int32()), *[pa.array(x, binary) for x in rest], nothing(m, ids.type), nothing(m, labels.type)], names
        )

    def chunks(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        no = (context.partitionId() if context else 0) << 32
        held: tuple[list, list, list] = ([], [], [])
        count = 0
        for batch in rows:
            at = 0
            while at < len(batch):
                part = batch.slice(at, chunk_rows - count)
                for kept, column in zip(held, (part.column("id"), part.column("label"), whole_numbers(matrix(part.column("v")), scale, LONGEST)), strict=True):
                    kept.append(column)
                count += len(part)
                at += len(part)
                if count == chunk_rows:
                    yield from chunk(no, *held)
                    held, count, no = ([], [], []), 0, no + 1
        if count:
            yield from chunk(no, *held)

    return chunks


def with_total(rows: DataFrame, label: str, value: str, out: str, most: int = MOST_LABELS) -> DataFrame:
    """Rows with the sum of a value over all rows of their label; nulls are one label.

    The sums are broadcast if there are few labels. Of many labels, the ``most``
    with the most rows are broadcast and only rows of the others are shuffled,
    none of which has more than one in ``most`` of all rows.
    """
    total = rows.groupBy(F.col(label).alias("_label")).agg(F.sum(value).alias(out), F.count("*").alias("_n"))
    total = written(total, "label-totals")
    join = lambda left, right: left.join(right.drop("_n"), left[label].eqNullSafe(right["_label"])).drop("_label")
    marked = small(total, most)
    if marked is not total:
        return join(rows, marked)
    common = written(total.orderBy(F.desc("_n"), "_label").limit(most), "label-common")
    hot = join(rows, F.broadcast(common))
    cold = rows.join(F.broadcast(common.select("_label")), rows[label].eqNullSafe(common["_label"]), "left_anti")
    return hot.unionByName(join(cold, total))


def compress_vectors(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, chunk: int = CHUNK, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", most_labels: int = MOST_LABELS) -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes array, error, label_error) of every kept vector, and the codebooks (part, entry, component).

    Component x counts as floor(scale * x). A codebook starts as its part of the
    ``entries`` vectors with the smallest ids and moves ``rounds`` times to the
    floor of its parts' mean. Dropped are vectors that are null or hold null or
    not finite components; as parts must be equal and comparable, so are those of
    another dimension than most kept vectors have (of dimensions held equally
    often the smallest counts), or all if it is no multiple of ``parts``. Defined
    cases: each row counts, repeated ones too, and rows of one id start in the
    order of their vectors; rows without an id come after all others there; fewer
    vectors than ``entries`` give fewer entries; no vectors, no rows; a vector
    longer than ``LONGEST`` in whole numbers is an error, as its errors fit no
    long; other columns are ignored.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), v.alias("v")).filter(finite(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    dims = sizes[0].d if sizes else 0
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    if not dims or dims % parts:
        empty = spark.createDataFrame([], f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error bigint, label_error bigint")
        return empty.withColumnsRenamed({"id": id_col, "label": label_col}), np.zeros((parts, 0, 0), "int64")
    width = dims // parts
    schema = f"chunk bigint, part int, n int, lo binary, hi binary, sums binary, values binary, rows binary, id {kinds['id']}, label {kinds['label']}"
    rows = rows.filter(F.size("v") == dims)
    stored = written(rows.mapInArrow(_chunks(scale, parts, chunk, block), schema), "code-blocks")
    kept, blocks = stored.filter("part is null"), stored.filter("part is not null")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    books = whole_numbers(np.array([r["v"] for r in first]), scale, LONGEST).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        tasks = blocks.select("part", "n", "lo", "hi", "sums", "values").mapInArrow(_sums(books), "sums array<bigint>")
        total = summed(tasks).reshape(parts, len(first), width + 1)
        size = total[:, :, width:]
        books = np.where(size > 0, total[:, :, :width] // np.maximum(size, 1), books)
    coded = blocks.select("chunk", "part", "lo", "hi", "values", "rows").mapInArrow(_codes(books), "chunk bigint, part int, rows binary, codes binary, errors binary")
    named = kept.select("chunk", F.col("n").alias("row"), "id", "label")
    both = coded.groupBy("chunk").cogroup(named.groupBy("chunk"))
    codes = written(both.applyInArrow(_together(parts, ["id", "label"]), f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error bigint"), "codes")
    discard(stored)
    release(spark)
    out = with_total(codes, "label", "error", "label_error", most_labels)
    return out.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "codes", "error", "label_error"), books


def code_text(codes: Column) -> Column:
    """Codes as text, two lowercase hex digits each."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c.cast("bigint"))), 2, "0")), "")
