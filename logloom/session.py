"""Session construction and the shared working folder.

Everything that has to be materialised (written tables, streaming
checkpoints, landed text logs) goes under the folder named by
``spark.checkpoint.dir``, on a cluster a shared one; a session that leaves it
unset works under the SQL warehouse, if that is shared or all is one process.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, app_name: str = "logloom",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this engine relies on.

    AQE stays on: it coalesces the small post-aggregation shuffles, splits
    skewed join partitions at run time and re-plans joins with measured
    sizes.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # AQE sizes post-shuffle partitions to ~128 MB whatever the initial
        # shuffle partition count, so one count serves every stage
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        # small splittable files still make a split per core
        "spark.sql.files.openCostInBytes": "1m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: What a micro-batch reads is a few small files: they are split for all cores,
#: whatever it costs to open a file once more.  A file stream is read with the
#: settings of the session that it was opened in, not with the query's own.
SPLIT_SMALL_FILES = {"spark.sql.files.openCostInBytes": "64k"}


def adaptive_session(batch: DataFrame) -> SparkSession:
    """The session of a micro-batch, with adaptive execution on.

    The engine turns it off in a stream's own session, as state must keep its
    number of partitions.  What a ``foreachBatch`` sink runs there has no such
    state; left off, each of its shuffles makes every shuffle partition a task,
    however few rows the batch has.  A megabyte, below which it would not split,
    is most of a batch.
    """
    spark = batch.sparkSession
    for k, v in SPLIT_SMALL_FILES.items():
        spark.conf.set(k, v)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    return spark


@contextmanager
def settings(spark: SparkSession, some: dict[str, str]):
    """A session's settings for a while."""
    before = {k: spark.conf.get(k, None) for k in some}
    for k, v in some.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: For an aggregate to a few rows: planned as a single job whose shuffle ends in
#: a single task.  Adaptive execution runs a job for each of its stages.
ONE_JOB = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "1"}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir`` (or the context's
    checkpoint directory when one was set with ``setCheckpointDir``).

    A session that names neither works under its SQL warehouse.  On a cluster
    that must be a shared store: a local folder is one machine's own there, so
    then the setting is demanded.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if sc.master.split("[")[0] != "local" and urlsplit(warehouse).scheme in ("", "file"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = warehouse.rstrip("/") + "/_work"
    return root.rstrip("/")


def work_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder; whoever writes creates it.

    ``unique=True`` appends a fresh id so concurrent or repeated runs never
    share (and never have to delete) a folder.
    """
    pieces = ["logloom", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    return "/".join([checkpoint_root(spark), *pieces])


def remove(spark: SparkSession, path: str, but: set[str] = frozenset()) -> None:
    """Delete a folder of the shared storage, whatever file system it is on;
    with ``but`` only what it holds under other names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not but:
        fs.delete(folder, True)
    elif fs.exists(folder):
        for found in fs.listStatus(folder):
            if found.getPath().getName() not in but:
                fs.delete(found.getPath(), True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def write_rows(spark: SparkSession, rows: pa.Table, path: str) -> None:
    """Replace a folder by one Parquet file of a few rows that the driver has
    (positions of a batch), without a Spark job.  The file is renamed into
    place, and ``_SUCCESS`` follows it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs.delete(folder, True)
    buffer = pa.BufferOutputStream()
    pq.write_table(rows, buffer)
    out = fs.create(at(path, "_part"), True)
    try:
        out.write(bytearray(buffer.getvalue()))
    finally:
        out.close()
    if not fs.rename(at(path, "_part"), at(path, "part-00000.parquet")):
        raise OSError(f"cannot write {path}")
    fs.create(at(path, "_SUCCESS"), True).close()


def folders(spark: SparkSession, path: str, complete: bool = False) -> list[str]:
    """Names of the folders in one, or of the tables that were written to their
    end; none when there is no such folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [f.getPath() for f in fs.listStatus(root) if f.isDirectory()]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return [p.getName() for p in found if not complete or fs.exists(done(p, "_SUCCESS"))]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"
