"""Session helpers: a tuned local session for tests and benches, and the shared
scratch folder used to cut lineage or stage rows."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "rillet", extra: dict | None = None) -> SparkSession:
    """A ``local[cores]`` session with AQE on, UTC time and no UI."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast only what AQE has measured after a shuffle (a proven size),
        # never a static estimate that can be far off after a parse or explode.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, purpose: str = "scratch") -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local-mode session without
    the setting (a test) gets its own temporary folder; on a cluster the
    setting is required, as executor-local folders are not shared.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        try:
            local = spark.sparkContext.master.startswith("local")
        except Exception:  # noqa: BLE001 - no context on the client (Spark Connect)
            local = False
        if not local:
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set(CHECKPOINT_CONF, root)
    return f"{root.rstrip('/')}/rillet/{purpose}-{uuid.uuid4().hex}"
