"""Session helpers.

The library never creates its own session in a core path; callers pass one in.
``build_session`` exists for tests, ``bench.py`` and local use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around: AQE for runtime join selection,
# partition coalescing and skew-join splitting; UTC so dates and timestamps
# compare with other engines; no UI server.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete checkpoint files of the range-sliced frames once they are unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tabula", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system), read from the session or the SparkContext. Only a local
    session without one (tests, local runs) gets a scratch folder; a cluster
    session without one is refused, since a driver-local folder would not
    hold what executors write. Every call returns the same root.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if named:
            sc.setCheckpointDir(named)
        elif sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabula-ckpt-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) for this cluster")
    return sc.getCheckpointDir().removeprefix("file:")


def shared_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "tables", name)
