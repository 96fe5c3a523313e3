"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits a hot key's partition of a sort-merge join at run time
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # splits a hot slot's partition before a slot write (REBALANCE hint)
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keeps keys of the cipher functions out of plans, the UI and event logs
    "spark.sql.redaction.string.regex": r"(?i)aes_?(?:en|de)crypt[^\n]*",
}


def build_session(app: str = "slotviews", **extra: str) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


#: folders that this process was given and has not cleared
_given: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    Falls back to a local temporary folder in local mode only: on a cluster a
    machine-local path would not be visible to the other machines.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        shared = tempfile.gettempdir()
    _given.append(f"{shared.rstrip('/')}/slotviews/{label}-{uuid.uuid4().hex}")
    return _given[-1]


def clear_scratch(spark: SparkSession) -> int:
    """Removes the scratch folders of this process; frames that read from them end with it."""
    count = 0
    while _given:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_given.pop())
        count += folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return count
