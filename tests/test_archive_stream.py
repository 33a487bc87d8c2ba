"""The archive sink as a stream (A6, S1, S2): every record once, files capped, a restart goes on where it was."""

from fleetspark.sources import archive as A
from fleetspark.sources.readings import load_messages
from fleetspark.streaming import ingest as S
from table_dirs import SF_SMALL


def test_archive_stream_keeps_every_record_once(spark, tmp_dir):
    records = A.to_kafka_records(load_messages(spark, SF_SMALL)).coalesce(2)
    source, path, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/archive", f"{tmp_dir}/ckpt"

    def run():
        stream = spark.readStream.schema(records.schema).parquet(source)
        S.archive_stream(stream, path, ckpt, max_records=20, available_now=True).awaitTermination()
        return A.read_archive(spark, path)

    records.write.parquet(source)
    files = run()
    per_file = [r["count"] for r in A.explode_records(files).groupBy("file_path").count().collect()]
    assert sum(per_file) == records.count() and max(per_file) <= 20
    assert run().count() == len(per_file)  # nothing new
    records.limit(5).write.mode("append").parquet(source)
    assert A.explode_records(run()).count() == records.count() + 5
