"""Session construction and the shared scratch location.

Library code never hard-codes a local temp folder: intermediate tables go under
``spark.checkpoint.dir`` (the shared folder a cluster names).  Only when that
setting is absent (unit tests, a laptop) is a private folder created and set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_given: list[str] = []  # scratch paths handed out by this process

# Settings every trackcast job relies on.  AQE re-plans joins at run time
# (broadcast only once a side is measured small, split skewed partitions),
# which is how hot artists are handled without hand-written salting.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "trackcast",
    driver_memory: str | None = None,
    extra: dict | None = None,
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """Local/test session with the settings above (clusters pass their own);
    ``checkpoint_dir`` is where written intermediates go."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if checkpoint_dir:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at the cluster's shared "
                           "file system (written intermediates go there)")
    local = tempfile.mkdtemp(prefix="trackcast-checkpoints-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint folder for one written table."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/trackcast/{name}-{uuid.uuid4().hex[:12]}"
    _given.append(path)
    return path


def scratch_mark() -> int:
    """A point in time for :func:`remove_scratch`."""
    return len(_given)


def remove_scratch(spark: SparkSession, since: int) -> None:
    """Delete the tables this process has written under the checkpoint folder since
    that mark; a job does so at its end, when nothing reads them any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while len(_given) > since:
        path = jvm.org.apache.hadoop.fs.Path(_given.pop())
        path.getFileSystem(conf).delete(path, True)


__all__ = ["build_session", "ensure_checkpoint_dir", "remove_scratch", "scratch_mark", "scratch_path", "RECOMMENDED_CONF"]
