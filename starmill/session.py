"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. All are runtime SQL settings, so they can also be applied to a session
# that a cluster hands over.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "starmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for checkpoints and intermediate tables that every executor can reach.

    The root is ``spark.checkpoint.dir``. Only a local session may go without it, because there
    driver and executors share one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="starmill-")
    return f"{root.rstrip('/')}/starmill/{purpose}-{uuid.uuid4().hex}"
