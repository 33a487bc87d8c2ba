"""The binary archive: ``date=YYYY-MM-DD/part-*.pb`` files of Kafka record batches.

Reading (A1-A5, A7, A9, A13, Q23):

* ``read_archive``: ``binaryFile`` source, ``*.pb`` only, ``_*`` / ``.*``
  paths skipped by Spark; ``date_from`` / ``date_to`` prune ``date=``
  folders before any file is opened (the folder date is the Kafka record
  date, so callers filtering on event time should leave a margin).
* ``explode_records``: one row per Kafka record; a file that does not parse
  yields no rows (``check_files`` reports it).
* ``decode_messages``: keep only the wanted ``message_type`` (a plain filter,
  so it runs before any Python), decode ``value`` in Arrow batches, drop
  undecodable messages, and add the Kafka coordinates.

Writing (A6): ``write_archive`` turns Kafka-shaped rows into one file per
(task, date, chunk of at most ``max_records``). It does not shuffle: every
task writes the dates it holds, so a hot day is spread over all tasks. Rows
are sorted inside each task so a retried task writes the same files under
the same names (temp name, then rename).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.model import RECORD_BATCH_MESSAGE, RECORD_MESSAGE, TELEMETRY_MESSAGE
from fleetspark.sources import protobuf as pb

#: Rows held as Python objects at once; Spark's own batches hold ten times as many.
BATCH_ROWS = 1024
DESCRIPTOR_PATH = "_schema/descriptor_set.desc"
RECORD_COLUMNS = ["topic", "partition", "offset", "timestamp", "key", "message_type", "value", "ingested_at"]


def _arrow_schema(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batches(rows: Iterator[dict], schema: T.StructType):
    import pyarrow as pa

    arrow = _arrow_schema(schema)
    buf = []
    for r in rows:
        buf.append(r)
        if len(buf) >= BATCH_ROWS:
            yield pa.RecordBatch.from_pylist(buf, schema=arrow)
            buf = []
    if buf:
        yield pa.RecordBatch.from_pylist(buf, schema=arrow)


def _rows(batches) -> Iterator[dict]:
    for batch in _slices(batches):
        yield from batch.to_pylist()


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


# ---------------------------------------------------------------------------
# Reading
# ---------------------------------------------------------------------------


def read_archive(spark: SparkSession, path: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Files of the archive (A1): ``file_path``, ``content``, ``date``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pb").load(path)
    if date_from is not None:
        files = files.where(F.col("date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        files = files.where(F.col("date") <= F.lit(date_to).cast("date"))
    cols = [F.col("path").alias("file_path"), "content"] + (["date"] if "date" in files.columns else [])
    return files.select(*cols)


def record_schema(descriptor_set: bytes | None = None) -> T.StructType:
    return pb.spark_schema(pb.message_descriptor(RECORD_MESSAGE, descriptor_set))


def explode_records(files: DataFrame, descriptor_set: bytes | None = None) -> DataFrame:
    """One row per Kafka record of every file (A2); records decoded with defaults."""
    rec_schema = record_schema(descriptor_set)
    out_schema = T.StructType([T.StructField("file_path", T.StringType())] + list(rec_schema.fields))

    def explode(batches):
        cls = pb.message_class(RECORD_BATCH_MESSAGE, descriptor_set)

        def rows():
            for batch in batches:
                # A batch may hold a whole split of files: only one at a time is copied and parsed.
                for path, content in zip(batch.column("file_path"), batch.column("content")):
                    path, msg = path.as_py(), pb.parse(cls, content.as_py())
                    if msg is None:
                        continue
                    for rec in msg.records:
                        row = pb.to_row(rec, emit_defaults=True)
                        row["file_path"] = path
                        yield row

        yield from _batches(rows(), out_schema)

    return files.select("file_path", "content").mapInArrow(explode, out_schema)


def check_files(files: DataFrame, descriptor_set: bytes | None = None) -> DataFrame:
    """Files that are not a valid record batch (Q23, file level): ``file_path``."""
    schema = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("decodes", T.BooleanType())])

    def check(batches):
        cls = pb.message_class(RECORD_BATCH_MESSAGE, descriptor_set)

        def rows():
            for batch in batches:
                for path, content in zip(batch.column("file_path"), batch.column("content")):
                    yield {"file_path": path.as_py(), "decodes": pb.parse(cls, content.as_py()) is not None}

        yield from _batches(rows(), schema)

    return files.select("file_path", "content").mapInArrow(check, schema).where(~F.col("decodes")).select("file_path")


def decode_column(
    df: DataFrame,
    message_type: str = TELEMETRY_MESSAGE,
    value_col: str = "value",
    out_col: str = "decoded",
    emit_defaults: bool = True,
    keep: Sequence[str] | None = None,
    descriptor_set: bytes | None = None,
) -> DataFrame:
    """Adds ``out_col``: ``value_col`` decoded as ``message_type`` (NULL when it does not parse)."""
    keep = [c for c in (keep if keep is not None else df.columns) if c != value_col]
    decoded_type = pb.spark_schema(pb.message_descriptor(message_type, descriptor_set))
    src = df.select(value_col, *keep)
    out_schema = T.StructType([T.StructField(out_col, decoded_type)] + [src.schema[c] for c in keep])

    def decode(batches):
        cls = pb.message_class(message_type, descriptor_set)

        def rows():
            for batch in _slices(batches):
                cols = {c: batch.column(c).to_pylist() for c in keep}
                for i, value in enumerate(batch.column(value_col).to_pylist()):
                    msg = pb.parse(cls, value)
                    row = {c: cols[c][i] for c in keep}
                    row[out_col] = None if msg is None else pb.to_row(msg, emit_defaults)
                    yield row

        yield from _batches(rows(), out_schema)

    return src.mapInArrow(decode, out_schema)


def decode_messages(
    records: DataFrame,
    message_type: str = TELEMETRY_MESSAGE,
    emit_defaults: bool = True,
    descriptor_set: bytes | None = None,
    type_col: str | None = "message_type",
) -> DataFrame:
    """Decoded messages with Kafka coordinates, undecodable ones dropped."""
    rows = records
    if type_col and type_col in records.columns:
        rows = rows.where(F.col(type_col) == message_type)
    keep = [c for c in ("partition", "offset", "timestamp", "ingested_at") if c in rows.columns]
    decoded = decode_column(rows, message_type, emit_defaults=emit_defaults, keep=keep, descriptor_set=descriptor_set)
    renames = {"partition": "kafka_partition", "offset": "kafka_offset", "timestamp": "kafka_timestamp", "ingested_at": "ingested_at"}
    return decoded.where(F.col("decoded").isNotNull()).select("decoded.*", *[F.col(c).alias(renames[c]) for c in keep])


def split_undecodable(
    records: DataFrame,
    message_type: str = TELEMETRY_MESSAGE,
    descriptor_set: bytes | None = None,
    type_col: str | None = "message_type",
) -> tuple[DataFrame, DataFrame]:
    """(decodable records with ``decoded``, undecodable records with their coordinates).

    The decode runs once: the decoded frame is checkpointed to the shared
    folder before it is split.
    """
    from fleetspark.session import materialize

    rows = records if not (type_col and type_col in records.columns) else records.where(F.col(type_col) == message_type)
    decoded = materialize(decode_column(rows, message_type, descriptor_set=descriptor_set))
    good = decoded.where(F.col("decoded").isNotNull())
    bad = decoded.where(F.col("decoded").isNull()).drop("decoded")
    return good, bad


def with_message_type(df: DataFrame, default: str = TELEMETRY_MESSAGE, headers_col: str = "headers") -> DataFrame:
    """``message_type`` from the ``message-type`` header, else ``default``."""
    if headers_col not in df.columns:
        return df.withColumn("message_type", F.lit(default))
    header = F.filter(F.col(headers_col), lambda h: h["key"] == F.lit("message-type"))
    value = F.get(header, 0)["value"].cast("string")
    return df.withColumn("message_type", F.coalesce(value, F.lit(default)))


def read_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Kafka stream from the earliest offset when nothing is committed (A12); needs the Kafka connector."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("includeHeaders", "true")
        .load()
    )
    return with_message_type(raw).select(
        "topic", "partition", "offset", "timestamp", F.col("key").cast("string").alias("key"), "message_type", "value",
        F.current_timestamp().alias("ingested_at"),
    )


# ---------------------------------------------------------------------------
# Encoding and writing
# ---------------------------------------------------------------------------


def encode_messages(
    messages: DataFrame,
    message_type: str = TELEMETRY_MESSAGE,
    keep: Sequence[str] = (),
    out_col: str = "value",
    descriptor_set: bytes | None = None,
) -> DataFrame:
    """Serializes message-shaped rows (fields named as in the message) into ``out_col`` bytes."""
    desc = pb.message_descriptor(message_type, descriptor_set)
    fields = [f.name for f in desc.fields if f.name in messages.columns]
    keep = list(keep)
    src = messages.select(*dict.fromkeys(fields + keep))
    out_schema = T.StructType([T.StructField(out_col, T.BinaryType())] + [src.schema[c] for c in keep])

    def encode(batches):
        cls = pb.message_class(message_type, descriptor_set)

        def rows():
            for row in _rows(batches):
                msg = cls()
                pb.fill(msg, {f: row.get(f) for f in fields})
                out = {c: row[c] for c in keep}
                out[out_col] = msg.SerializeToString()
                yield out

        yield from _batches(rows(), out_schema)

    return src.mapInArrow(encode, out_schema)


def to_kafka_records(messages: DataFrame, topic: str = "vehicle-telemetry", message_type: str = TELEMETRY_MESSAGE) -> DataFrame:
    """Decoded-shape messages (with Kafka columns) -> Kafka record rows with the message serialized in ``value``."""
    keep = ["kafka_partition", "kafka_offset", "kafka_timestamp", "ingested_at", "vehicle_id"]
    encoded = encode_messages(messages, message_type, keep=keep)
    return encoded.select(
        F.lit(topic).alias("topic"),
        F.col("kafka_partition").cast("int").alias("partition"),
        F.col("kafka_offset").cast("long").alias("offset"),
        F.col("kafka_timestamp").cast("timestamp").alias("timestamp"),
        F.col("vehicle_id").alias("key"),
        F.lit(message_type).alias("message_type"),
        "value",
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
    )


def write_descriptor_set(path: str, descriptor_set: bytes | None = None) -> str:
    """Writes the descriptor set next to the archive (temp name, then rename)."""
    import pyarrow.fs as pafs

    fs, base = pafs.FileSystem.from_uri(_uri(path))
    target = f"{base.rstrip('/')}/{DESCRIPTOR_PATH}"
    fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
    tmp = target.rsplit("/", 1)[0] + f"/.descriptor_set.desc.{uuid.uuid4().hex[:8]}.tmp"
    with fs.open_output_stream(tmp) as out:
        out.write(descriptor_set or pb.file_descriptor_set_bytes())
    fs.move(tmp, target)
    return target


def _uri(path: str) -> str:
    """The path with the scheme of the cluster's default file system, resolved on the driver."""
    spark = SparkSession.getActiveSession()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def write_archive(records: DataFrame, path: str, max_records: int = 5000, prefix: str | None = None, descriptor_set: bytes | None = None) -> DataFrame:
    """Writes Kafka-shaped rows as ``date=YYYY-MM-DD/<prefix>-<task>-<chunk>.pb`` files.

    Without a ``prefix`` each call takes a fresh one, so no two writers share
    file names; a writer that repeats a batch passes the same prefix and
    replaces its own files. Returns the file manifest (date, file, records) as
    written to ``<path>/_manifest`` (ignored by archive readers).
    """
    prefix = prefix or f"part-{uuid.uuid4().hex}"
    write_descriptor_set(path, descriptor_set)
    root = _uri(path)
    day = F.to_date(F.coalesce(F.col("timestamp"), F.col("ingested_at")))
    src = records.select(*RECORD_COLUMNS, day.alias("_date")).sortWithinPartitions("_date", "partition", "offset", "ingested_at")
    manifest_schema = T.StructType(
        [T.StructField("date", T.DateType()), T.StructField("file", T.StringType()), T.StructField("records", T.LongType())]
    )

    def write(batches):
        import pyarrow.fs as pafs
        from pyspark import TaskContext

        fs, base = pafs.FileSystem.from_uri(root)
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        cls = pb.message_class(RECORD_BATCH_MESSAGE, descriptor_set)
        chunks: dict[dt.date, int] = {}
        out = []

        def flush(day_value, batch_msg):
            seq = chunks.get(day_value, 0)
            chunks[day_value] = seq + 1
            folder = f"{base.rstrip('/')}/date={day_value.isoformat()}"
            fs.create_dir(folder, recursive=True)
            name = f"{prefix}-{task:05d}-{seq:05d}.pb"
            tmp = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}.tmp"
            with fs.open_output_stream(tmp) as stream:
                stream.write(batch_msg.SerializeToString())
            fs.move(tmp, f"{folder}/{name}")
            out.append({"date": day_value, "file": f"{folder}/{name}", "records": len(batch_msg.records)})

        current_day, current = None, None
        for row in _rows(batches):
            d = row.pop("_date")
            if current is not None and (d != current_day or len(current.records) >= max_records):
                flush(current_day, current)
                current = None
            if current is None:
                current_day, current = d, cls()
            pb.fill(current.records.add(), row)
        if current is not None and len(current.records):
            flush(current_day, current)
        yield from _batches(iter(out), manifest_schema)

    manifest = src.mapInArrow(write, manifest_schema)
    manifest_path = f"{path.rstrip('/')}/_manifest/{prefix}"
    manifest.write.mode("overwrite").parquet(manifest_path)
    return records.sparkSession.read.parquet(manifest_path)


def telemetry_archive(spark: SparkSession, path: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Archive -> decoded telemetry messages with Kafka coordinates (the staging input)."""
    return decode_messages(explode_records(read_archive(spark, path, date_from, date_to)), TELEMETRY_MESSAGE)
