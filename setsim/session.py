"""Session construction and the shared scratch location.

Intermediate tables (fingerprints, round-trip outputs) are written under the
checkpoint directory the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent (local tests) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


def get_spark(master: str | None = None, app_name: str = "setsim",
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library relies on.

    On a cluster, ``master`` stays None and the launcher decides; locally,
    pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no context
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory; set a local one only if none is set."""
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local[") and master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # One machine: a fresh private directory.
        configured = tempfile.mkdtemp(prefix="setsim-ckpt-")
    if sc is None:
        spark.conf.set("spark.checkpoint.dir", configured)
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint directory."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/setsim/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor re-reads files instead of
    recomputing the plan) and gives later stages real file statistics."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    # The schema is known: no footer-reading job to infer it again.
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Tasks that follow the data: about ``rows_per_task`` rows each, and at
    least one for each core as long as there are rows to share."""
    return max(1, -(-int(rows) // rows_per_task), min(int(rows), default_parallelism(spark)))


def default_parallelism(spark: SparkSession) -> int:
    """Cluster parallelism: the larger of the default parallelism and the
    shuffle partition count (the latter alone under Spark Connect)."""
    sc = _context(spark)
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, shuffle, int(sc.defaultParallelism) if sc is not None else 1)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
