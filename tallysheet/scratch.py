"""Where intermediate files go: the folder the cluster shares, named in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path. Only a local session may do without the setting and gets a temporary folder;
    executors of a cluster would write there each to their own disk."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tallysheet-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
