"""Session helpers for tests, the bench and local runs.

Library functions never change session settings; they take the session the
caller built.  ``local_session`` is what the tests and ``bench.py`` use.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext on this side (e.g. a remote client)
        return None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "basket") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; set a local one only when none is named.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is (a cluster without one is an error); the temporary-folder fallback is for
    local masters only (local runs, tests).
    """
    d = checkpoint_dir(spark)
    if d:
        return d
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError(
            "no checkpoint folder: set spark.checkpoint.dir to a folder shared by the cluster"
        )
    d = tempfile.mkdtemp(prefix="basket-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(d)
    return d


def run_concurrently(*tasks):
    """Run independent Spark actions from separate threads and return their results.

    Spark schedules jobs submitted from different threads side by side, so small
    independent jobs overlap instead of queueing behind each other.  Errors
    propagate from the first failing task.
    """
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the file system and the folder that Spark's writers would resolve it against."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder, deleted when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path
