"""Session defaults and the shared scratch area.

Library operators never mutate the session; runners and tests call
:func:`build_session` / :func:`ensure_utc`. Scratch data (stream checkpoints,
landed tables used to cut lineage) lives under the cluster's shared
``spark.checkpoint.dir``; only when that is unset (local tests) a private
directory is created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "txlake", shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Session with the library defaults; ``master=None`` keeps what spark-submit set."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for k, v in merged.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """hour()/to_date() follow the session zone; analytics are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory named by the session (``spark.checkpoint.dir``).

    Only a local-mode session (tests, a laptop) without one gets a private
    temporary directory; on a cluster a machine-local folder would not be
    shared by executors or survive their loss, so a missing setting is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder (HDFS / object store) on a cluster")
        d = tempfile.mkdtemp(prefix="txlake-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/txlake/{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:  # pragma: no cover - connect sessions have no SparkContext
        return max(1, int(os.cpu_count() or 1))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path`` (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)  # noqa: SLF001


def rename(spark: SparkSession, source: str, target: str, replace: bool = False) -> None:
    """Moves a folder in one step; if ``target`` is there, it fails or, with ``replace``, deletes that first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = b.getFileSystem(conf)
    fs.mkdirs(b.getParent())
    if replace:
        fs.delete(b, True)
    if fs.exists(b) or not fs.rename(a, b):
        raise FileExistsError(f"cannot move {source} to {target}")


def scratch_sibling(path: str, name: str) -> str:
    """A new folder beside the data in ``path``, on the same file system; the leading ``_`` hides it from readers."""
    return f"{path.rstrip('/')}/{name if name.startswith('_') else '_' + name}-{uuid.uuid4().hex[:12]}"


def sizing_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Shuffle settings for an input of ``input_bytes`` on ``total_cores`` cores.

    AQE starts from ``initialPartitionNum`` (about one partition per
    ``target_partition_bytes`` of input, at least 2 per core) and coalesces
    small ones after measuring; skewed partitions are split in joins.
    """
    n = max(2 * total_cores, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (Hadoop content summary; no data is read)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return int(fs.getContentSummary(p).getLength())


def input_version(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files at ``path``: changes whenever the input does."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return tuple((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p))


def apply_sizing(spark: SparkSession, path: str) -> dict:
    """Set the shuffle sizing of :func:`sizing_conf` for the input at ``path``."""
    conf = sizing_conf(input_bytes(spark, path), default_parallelism(spark))
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def partitions_for_input(spark: SparkSession, path: str, target_partition_bytes: int = 128 << 20) -> int:
    """One partition per ``target_partition_bytes`` of the input at ``path``, at least the parallelism."""
    return max(default_parallelism(spark), -(-input_bytes(spark, path) // int(target_partition_bytes)))
