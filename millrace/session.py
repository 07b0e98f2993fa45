"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def build_session(name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators were planned for.

    AQE is left to size shuffles: it starts wide and coalesces, splits skewed join
    partitions and turns small joins into broadcasts after measuring them.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without it (tests); a cluster session without a shared
    folder is an error, because a machine-local folder would lose data with its host.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if sc.applicationId not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="millrace-")
        root = _LOCAL_ROOTS[sc.applicationId]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so nothing is overwritten."""
    return f"{scratch_root(spark)}/millrace/{label}-{uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    scratch_root(df.sparkSession)
    return df.checkpoint()


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Write a table once to the shared folder and read it back.

    For wide tables that several later jobs read: unlike a checkpoint the copy is columnar,
    so each of those jobs reads only its columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._written_to = path
    return out


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def short_methods(spark: SparkSession) -> AbstractContextManager[None]:
    """For jobs with very wide projections, run inside.

    The JVM never compiles a method of more than 8,000 bytes. With this limit Spark doesn't fuse
    such a projection into one method, but cuts it into many.
    """
    return _setting(spark, "spark.sql.codegen.hugeMethodLimit", "8000")


def small_batches(spark: SparkSession, rows: int = 512) -> AbstractContextManager[None]:
    """For jobs that hand whole texts or long arrays to Python, run inside: a task holds one batch, in Spark and in Python."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def short_lived_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """For chains of large jobs that each write a table, run inside: shuffle files go as soon as their job has ended.

    Otherwise they stay until the driver happens to collect its garbage, and fill the executors' disks.
    """
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def release(*tables: DataFrame) -> None:
    """Delete copies made by ``write_through`` once nothing that is still to run reads them."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
