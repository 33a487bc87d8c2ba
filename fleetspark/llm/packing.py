"""Packing: concatenate and cut.

Two passes of prefix sums: a task that encodes a partition's documents adds up
their lengths, the partitions' totals are summed in order, and their sum before
a partition plus the sum within it is a document's place in the one long stream
of ids. The stream is cut every ``length`` ids; a document on a cut leaves a
piece on either side, marked as cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import small, work_path, written
from fleetspark.llm.tokens import read_spec, token_batches

LENGTH = 1024
#: Partitions whose offsets are broadcast at most.
MOST_PARTS = 1_000_000
#: Pieces that a task sends back at once, of ``length`` ids at most.
PIECES_AT_ONCE = 1024
STREAM = "doc_id {id}, part int, local_start bigint, n bigint, ids binary"
PIECES = "doc_id {id}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, cut_before boolean, cut_after boolean, ids binary"


def token_stream(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """First pass, written: per document its ids, its partition and its place within that partition."""
    batches = token_batches(read_spec(tokenizer), end_id)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = STREAM.format(id=picked.schema["doc_id"].dataType.simpleString())

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in rows:
            ids_of, at = batch.column("doc_id"), 0
            for ids in batches(batch.column("text").to_pylist()):
                n = np.array([len(x) // 4 for x in ids], "int64")
                starts = total + np.cumsum(n) - n
                total += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [ids_of.slice(at, len(ids)), pa.array(np.full(len(ids), part, "int32")), pa.array(starts), pa.array(n), pa.array(ids, pa.binary())],
                    ["doc_id", "part", "local_start", "n", "ids"],
                )
                at += len(ids)

    stream = picked.mapInArrow(encode, schema)
    path = work_path(docs.sparkSession, "token-stream")
    stream.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(stream.schema).parquet(path)


def with_offsets(stream: DataFrame) -> DataFrame:
    """Second pass: the global place of each row, from the totals of the partitions.

    The table of totals has one row of 12 bytes per input partition; it is
    counted, and broadcast up to ``MOST_PARTS`` rows.
    """
    totals = stream.groupBy("part").agg(F.max(F.col("local_start") + F.col("n")).alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = written(totals.select("part", before.alias("base")).coalesce(1), "token-bases")
    return stream.join(small(bases, MOST_PARTS), "part").withColumn("place", F.col("base") + F.col("local_start"))


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[pa.RecordBatch]:
    """The pieces of some placed documents, ``PIECES_AT_ONCE`` at a time."""
    place, n = batch.column("place").to_numpy(), batch.column("n").to_numpy()
    first, last = place // length, (place + n - 1) // length
    count = last - first + 1
    row = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    sequence = first[row] + nth
    begin = np.maximum(place[row], sequence * length)
    end = np.minimum(place[row] + n[row], (sequence + 1) * length)
    start = begin - place[row]
    # A batch's pieces are its documents' ids in order, so they share its buffer and only the offsets differ.
    ids = batch.column("ids")
    offsets = np.frombuffer(ids.buffers()[1], "int32")[ids.offset : ids.offset + len(ids) + 1]
    piece_offsets = np.append(offsets[row] + 4 * start, offsets[-1]).astype("int32")
    pieces = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(piece_offsets), ids.buffers()[2]])
    cut_rows = pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(pa.array(row)),
            pa.array(start),
            pa.array(end - begin),
            pa.array(n[row]),
            pa.array(sequence),
            pa.array(begin - sequence * length),
            pa.array(start > 0),
            pa.array(end < place[row] + n[row]),
            pieces,
        ],
        ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "cut_before", "cut_after", "ids"],
    )
    for at in range(0, len(row), PIECES_AT_ONCE):
        yield cut_rows.slice(at, PIECES_AT_ONCE)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document: where it starts in its document, its sequence and offset there, and its ids.

    All sequences but the last are full. Defined cases: a null text is empty
    and gives its end id alone; repeated rows are documents of their own; a
    null id stays null; an empty table gives no rows; other columns are
    ignored, whatever their names.
    """
    placed = with_offsets(token_stream(docs, tokenizer, end_id, id_col, text_col)).select("doc_id", "place", "n", "ids")
    schema = PIECES.format(id=placed.schema["doc_id"].dataType.simpleString())

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if batch.num_rows:
                yield from _pieces(batch, length)

    return placed.mapInArrow(cut, schema).withColumnRenamed("doc_id", id_col)


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """The packed sequences: ids in offset order, padded to ``length`` (at most ``length`` pieces each)."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    packed = pieces.groupBy("sequence_id").agg(rows.alias("rows"), F.sum("length").alias("filled"))
    pad = F.lit(pad_id.to_bytes(4, "little"))
    filler = F.aggregate(F.array_repeat(pad, (F.lit(length) - F.col("filled")).cast("int")), F.lit(b""), lambda a, x: F.concat(a, x))
    joined = F.aggregate("rows", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.select("sequence_id", "filled", F.concat(joined, filler).alias("ids"))
