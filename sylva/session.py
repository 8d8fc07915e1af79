"""Session helpers: a local session for tests and the bench, and the shared folder
(``spark.checkpoint.dir``) where snapshots and lineage cuts are written."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def get_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "sylva",
                checkpoint_dir: str | None = None) -> SparkSession:
    """Local session used by tests and ``bench.py``, which name their ``checkpoint_dir``. On a
    cluster, build your own session; the library reads only ``spark.checkpoint.dir``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folders of the work in progress, the innermost last; each thread has its own.
_WORK: ContextVar[tuple[str, ...]] = ContextVar("work_folders", default=())


def _checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder, read from the session. Only a session in one process
    (``local`` or ``local[...]``) that names none gets a fresh temporary folder."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: set it to a folder every executor can reach "
            "(HDFS, S3, ...) before running sylva jobs on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sylva-ckpt-"))
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder (or of the open ``work_folder``), one per call."""
    work = _WORK.get()
    root = work[-1] if work else _checkpoint_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def work_folder(spark: SparkSession):
    """A folder for the intermediate tables of the block, deleted at its end. Queries return lazy
    results that read such tables, so write or collect the result inside the block."""
    path = shared_dir(spark, "work")
    token = _WORK.set((*_WORK.get(), path))
    try:
        yield path
    finally:
        _WORK.reset(token)
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df, name: str):
    """Cut lineage by writing ``df`` to a fresh folder under the shared folder and reading it back.
    Unlike ``checkpoint()`` on an uncached plan, the plan runs once; unlike caching, the
    result survives the loss of an executor."""
    path = shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


__all__ = ["get_session", "shared_dir", "work_folder", "materialize"]
