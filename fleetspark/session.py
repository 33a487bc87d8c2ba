"""SparkSession helpers and the shared work folder.

Tables written between steps (staging, merge targets, snapshots, archives)
go under the folder the cluster names in ``spark.checkpoint.dir``; that
folder is shared by all executors, so a lost executor never takes a written
table with it. Only when it is unset (local runs, tests) do we pick one.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "fleetspark") -> SparkSession:
    """A session with the settings every job here relies on (UTC, AQE)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Applies the session-level settings to an existing session (the driver's)."""
    for key, value in DEFAULT_CONF.items():
        if key.startswith("spark.ui"):
            continue
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for what is planned or started inside; the session's own come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's setting, else a local one for tests."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="fleetspark-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


_owned: set[str] = set()


def work_root(spark: SparkSession) -> str:
    """The application's own folder for work tables; whatever is left in it goes when the application ends."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/fleetspark-work/{spark.sparkContext.applicationId}"
    if root not in _owned:
        _owned.add(root)
        atexit.register(_leave, spark, root)
    return root


def _leave(spark: SparkSession, root: str) -> None:
    if not spark._jsc.sc().isStopped():
        discard_path(spark, root)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one written table, below the application's own."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def discard_path(spark: SparkSession, path: str) -> None:
    """Deletes a work table that nothing reads any more, through the cluster's file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df):
    """Writes ``df`` to the shared checkpoint folder and cuts its lineage (reliable, survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
