"""Spark session defaults and the shared checkpoint folder.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a shared
filesystem the cluster names). Only when that setting is absent -- local runs and
tests -- do we create a scratch folder of our own.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the engine relies on: UTC session clock, ANSI arithmetic, AQE.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "churnlens") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    heap = os.environ.get("CHURNLENS_DRIVER_MEMORY") or (local_heap() if (master or "").startswith("local") else None)
    if heap:   # a cluster's own setting stays
        builder = builder.config("spark.driver.memory", heap)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def local_heap() -> str:
    """Heap of a local session: two fifths of the machine's memory, 12 GB at most."""
    total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    return f"{max(1024, min(12 * 1024, total * 2 // 5 // (1 << 20)))}m"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; a scratch one is made only where none is set and all runs in one
    process (a local master). On a cluster each executor would write to its own disk, so that raises."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="churnlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


NAMESPACE_CONF = "spark.churnlens.scratch.namespace"


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediate tables).

    Everything lives under ``<checkpoint dir>/<namespace>``; the namespace defaults to
    ``churnlens`` and a benchmark sets a fresh one so it never reuses earlier builds.
    """
    base = ensure_checkpoint_dir(spark)
    ns = spark.conf.get(NAMESPACE_CONF, "churnlens")
    return "/".join([base.rstrip("/"), ns, *parts])


def apply_query_defaults(spark: SparkSession) -> None:
    """Settings every query relies on that can change at runtime (the clock is UTC, as the oracle's)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem API (local disk, HDFS or object stores)."""
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def file_fingerprints(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of every file under ``path``, recursively."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        out.append((st.getPath().toString(), int(st.getLen()), int(st.getModificationTime())))
    return sorted(out)


def rename_path(spark: SparkSession, src: str, dst: str) -> bool:
    """Atomic directory rename where the filesystem offers it; False when ``dst`` already exists."""
    s, fs = _fs(spark, src)
    d, _ = _fs(spark, dst)
    if fs.exists(d):
        return False
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    return bool(fs.rename(s, d))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; one that isn't there is none to delete."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def tune_for_input(spark: SparkSession, roots: list[str], target_partition_bytes: int = 256 * 1024 * 1024,
                   min_partitions: int = 8, max_partitions: int = 100_000) -> int:
    """Size shuffles from the data: initial shuffle partitions ~ input bytes / target (AQE coalesces
    small ones at runtime down to the advisory size), scan splits of the same target size.

    At 100 TB this gives ~400k -> clamped to 100k initial partitions; at sf0.1 the minimum.
    Returns the partition count it set.
    """
    total = sum(n for root in roots for _, n, _ in file_fingerprints(spark, root))
    parts = max(min_partitions, min(max_partitions, -(-total // target_partition_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes // 2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes // 2))
    return parts


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the direct children of ``path`` (Hadoop FileSystem API)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(p))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per session (Python functions refer to it by name).

    Spark's own file distribution carries the archive, so executors need no shared install.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="churnlens-ship-")) / "churnlens.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()
