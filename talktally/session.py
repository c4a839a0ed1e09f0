"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine is tuned for. Shuffle partitions are left to the cluster:
# adaptive execution joins small ones, and a stream keeps the number it started with.
SESSION_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the one the session names in spark.checkpoint.dir.

    Only a local session may go without that setting; a cluster needs a folder that
    every executor sees.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="talktally-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
