"""Session set-up and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "parcelspark", master: str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session with the settings the operators expect.

    AQE coalesces small shuffle partitions and splits skewed join partitions. On a cluster leave
    ``shuffle_partitions`` unset and size it there: AQE merges what is too fine, but cannot cut what is too coarse.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


#: Work folders made for local sessions without a shared one, by application id.
_OWN: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Only a local session may fall back to a folder of its own: on a cluster a machine-local path would be unreadable
    to the other executors, so a missing setting is an error there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _OWN[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex}")
