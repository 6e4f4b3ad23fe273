"""Session helpers: one place for the settings every job here relies on."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "cellwise", **conf) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    AQE stays on so skewed shuffle partitions are split at run time and small
    ones coalesced; the session time zone is pinned so epoch-ms conversions of
    ``timestamp`` values are reproducible.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    defaults.update(conf)
    for k, v in defaults.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) is a fresh
    scratch folder created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: scratch data "
                               "must survive the loss of any one machine")
        root = tempfile.mkdtemp(prefix="cellwise-ckpt-")     # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique directory path below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/cellwise/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works on any store."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(hconf).exists(p))


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path, on any Hadoop filesystem."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename one file, on any Hadoop filesystem."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(old).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(path(old), path(new)):
        raise OSError(f"cannot rename {old}")


def list_file_sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(file, bytes) of every data file below ``path``, from file-system
    metadata only (no data is read)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(hconf)
    if not fs.exists(p):
        return []
    out = []
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if not name.startswith((".", "_")):
            out.append((st.getPath().toString(), int(st.getLen())))
    return out


__all__ = ["get_spark", "checkpoint_root", "scratch_path", "path_exists", "drop_path", "rename_path", "list_file_sizes"]
