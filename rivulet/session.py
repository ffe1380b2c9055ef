"""Session and shared-folder helpers.

Jobs never pick a machine-local folder on a cluster: intermediate tables and
streaming checkpoints live under the shared folder the cluster names in
``spark.checkpoint.dir``. Only when that is unset *and* the master is local
(tests, laptops) do we create one under the system temp folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

STATE_STORE_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(master: str = "local[8]", app: str = "rivulet",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs. Clusters bring their own."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect: no SparkContext on the client
        return spark.conf.get("spark.app.id", "app")


def parallelism(spark: SparkSession) -> int:
    """Cores available to the application (task slots)."""
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, written tables and stream checkpoints."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the setting
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("spark.checkpoint.dir is not set on the server")
        return conf.rstrip("/")
    root = sc.getCheckpointDir()
    if root:
        # getCheckpointDir() names an application sub-folder; use its parent
        # so different applications of one job can share written tables.
        return root.rsplit("/", 1)[0]
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return conf.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running rivulet jobs on a cluster")
    local = tempfile.mkdtemp(prefix="rivulet-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    root = checkpoint_root(spark)
    return f"{root}/rivulet/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side checks in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


def ensure_state_store(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB provider; it is a runtime conf."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STATE_STORE_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)


__all__ = ["build_session", "app_id", "parallelism", "checkpoint_root", "scratch_path", "local_path",
           "ensure_state_store"]
