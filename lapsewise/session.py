"""SparkSession helpers.

Library code never creates its own cluster settings: it reads what the session
already has.  ``local_session`` is for tests, the bench and the examples.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lapsewise",
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LAPSEWISE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for lineage cuts and stage layers.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only when neither is set and the master is local (tests, the bench) a
    scratch folder is created and registered, so every later call in the
    session agrees on it; on a cluster a machine-local folder would not be
    shared, so an unset setting is an error there.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: the stage layers are written there")
    scratch = tempfile.mkdtemp(prefix="lapsewise-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir().rstrip("/")
