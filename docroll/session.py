"""Session construction and the shared scratch folder.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (or a
directory already given to ``SparkContext.setCheckpointDir``). Only a local
master may fall back to a fresh temporary folder, as the tests do.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on; a caller's own settings win.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "docroll",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``shuffle_partitions`` should follow the data size: about one partition per
    128-256 MB of shuffled data at scale, about the core count locally. AQE
    coalesces small partitions and splits skewed ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temp folder only in local mode."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        try:
            named = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # unset
            named = None
    current = sc.getCheckpointDir()
    if named:
        if not current:
            sc.setCheckpointDir(named)
        return named
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: a cluster job needs a shared folder "
            "for checkpoints and written intermediate tables"
        )
    local = tempfile.mkdtemp(prefix="docroll-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/docroll-scratch/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, through Hadoop's FileSystem (works
    for any shared store the cluster names)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hpath, True)


def stage(df, name: str):
    """Write a (small) intermediate result once to the shared folder and read
    it back: computed once, and stable when a later task is retried."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
