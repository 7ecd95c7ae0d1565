"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; anything the cluster already sets wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join key even where the split costs one more shuffle behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above, overridden by ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int, target_bytes: int = 128 << 20, at_least: int = 200) -> int:
    """Initial shuffle partitions for a load of this size; AQE merges the small ones, so too many is the safe side.

    Pass the result as ``spark.sql.shuffle.partitions``: 100 TB gives about 820,000.
    """
    return max(at_least, -(-input_bytes // target_bytes))


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only where ``spark.checkpoint.dir`` is unset and all work is done in this
    process (tests) a local folder is made and recorded in the session, so later calls
    agree; a cluster without the setting is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallyloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/tallyloom/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Written to the shared folder and read again: computed once however often it is used, and a bare scan to joins."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options or {}).parquet(path)
    return df.sparkSession.read.parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)
