"""Session and shared-storage helpers.

Nothing here hard-codes cluster sizing: defaults are applied only where the
caller's session leaves a setting unset, so a cluster's own configuration wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every fundflow job relies on. AQE coalesces the many shuffle
# partitions a large cluster needs into few on small inputs, splits skewed
# join partitions, and can switch a sort-merge join to a broadcast at run time.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app: str = "fundflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with fundflow's recommended settings.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them None so spark-submit / the cluster config decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset *and* the master is local
    (tests, a laptop) a private scratch folder is created and registered. On
    a cluster an unset value is an error, so lineage cuts, stage tables and
    streaming checkpoints never land on a machine-local path.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext.getCheckpointDir()
        root = jdir if jdir else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder is not shared by executors: refuse.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                               "for stage tables and streaming checkpoints")
        root = tempfile.mkdtemp(prefix="fundflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root (see :func:`drop_scratch`)."""
    path = f"{checkpoint_root(spark)}/fundflow/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def drop_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete scratch folders that this process made (default: all of them), once nothing that
    reads them is needed any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in list(_SCRATCH if paths is None else paths):
        folder = jvm.org.apache.hadoop.fs.Path(p)
        folder.getFileSystem(conf).delete(folder, True)
        if p in _SCRATCH:
            _SCRATCH.remove(p)


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme for tests that inspect files directly."""
    return p[5:] if p.startswith("file:") else p


def ensure_dir(p: str) -> str:
    os.makedirs(local_path(p), exist_ok=True)
    return p
